"""Transcript parsing: roles of lines by a hidden Markov model and Viterbi, then canonical turns."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverspark.llm.texts import give_back
from coverspark.session import cut, ship

ROLES = ("system", "user", "assistant")
#: Speaker markers at the start of a line, by role.
MARKERS = {"system": "system|sys|instructions?|context", "user": "user|human|question|customer|me|q", "assistant": "assistant|ai|bot|answer|agent|a"}
_OPEN = r"(?i)^\s*(?:#+\s*|\*\*|<\|?|\[)?(?:{})(?:\|?>|\]|\*\*)?\s*(?::|>|\n)\s*"
#: Levels of the decoding, as bits of a line's place that its group leaves out: 32 lines, 1,024 such groups, a partition.
_LEVELS = (5, 15, 33)


@dataclass(frozen=True)
class ChatModel:
    """Log probabilities: first role, next role in a line after a gap or with a speaker marker (`following`) and in others (`within`), and of each feature's values by role."""

    first: np.ndarray
    following: np.ndarray
    features: dict[str, np.ndarray]
    within: np.ndarray


def _split(text: Column) -> Column:
    """The non-blank lines of a text as (line, text, gap): gap if a blank line or nothing is before it. At least one line."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    pairs = F.arrays_zip(lines.alias("text"), F.concat(F.array(F.lit("")), lines).alias("earlier"))
    before = F.transform(pairs, lambda x, k: F.struct(k.cast("long").alias("line"), x["text"].alias("text"), (F.trim(x["earlier"]) == "").alias("gap")))
    before = F.filter(before, lambda x: x["text"].isNotNull())
    seen = F.filter(before, lambda x: F.trim(x["text"]) != "")
    return F.when(F.size(seen) > 0, seen).otherwise(F.slice(before, 1, 1))


def transcript_lines(transcripts: DataFrame, id_col: str = "conv_id", text_col: str = "text") -> DataFrame:
    """(id, turn, text, gap): the non-blank lines of whole transcripts, numbered; null texts have none."""
    lines = transcripts.where(F.col(text_col).isNotNull()).select(id_col, F.explode(_split(F.col(text_col))).alias("l"))
    return lines.select(id_col, F.col("l.line").alias("turn"), "l.text", "l.gap").where(F.trim("text") != "")


def turn_lines(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, line, text, gap): conversations as transcripts, their turns' lines in order with a blank line before each turn.

    A turn without a visible line is one blank line, so every row of `turns` has a line at least.
    """
    lines = turns.select("conv_id", "turn", "role", F.explode(_split(F.col("text"))).alias("l"))
    return lines.select("conv_id", "turn", "role", "l.line", "l.text", "l.gap")


def _features(text: Column) -> dict[str, Column]:
    """What is seen of a line, as small numbers; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    marker = F.lit(0)
    for k, role in reversed(list(enumerate(ROLES))):
        marker = F.when(t.rlike(_OPEN.format(MARKERS[role])), k + 1).otherwise(marker)
    length = F.least(F.floor(F.log2(F.length(t) + 1) * 2), F.lit(31)).cast("int")
    breaks = F.least(F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))), F.lit(7)).cast("int")
    asks = F.rtrim(t).endswith("?").cast("int")
    return {"marker": marker, "length": length, "breaks": breaks, "asks": asks}


#: Number of values of each feature.
_VALUES = {"marker": 4, "length": 32, "breaks": 8, "asks": 2}


def fit_chat(lines: DataFrame, sample_turns: int = 20000) -> ChatModel:
    """Smoothed counts over the first `sample_turns` labelled rows by a hash of the conversation.

    lines has conv_id, turn, role, text and may have line and gap (turn_lines); without gap every row follows one. Roles
    other than ROLES are ignored. Markers also have a fixed strong prior: a marker names its role.
    """
    known = lines.where(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    line = F.col("line") if "line" in lines.columns else F.lit(0)
    gap = F.col("gap") if "gap" in lines.columns else F.lit(True)
    seen = _features(F.col("text"))
    own = known.select("conv_id", "turn", line.alias("line"), "role", (gap | (seen["marker"] > 0)).alias("gap"), *(c.alias(n) for n, c in seen.items()))
    own = cut(own.orderBy(F.xxhash64(F.lit(10), "conv_id"), "conv_id", "turn", "line").limit(sample_turns))
    code = {r: k for k, r in enumerate(ROLES)}
    features = {n: np.full((len(ROLES), v), 0.5) for n, v in _VALUES.items()}
    features["marker"] = np.array([[200.0] + [50.0 if k == r else 0.2 for k in range(3)] for r in range(3)])
    for n in _VALUES:
        for r in own.groupBy("role", n).count().collect():
            features[n][code[r["role"]], r[n]] += r["count"]
    features["length"] = features["length"] + 0.25 * (np.roll(features["length"], 1, 1) + np.roll(features["length"], -1, 1))
    before = own.withColumn("before", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn", "line")))
    first, following, within = np.full(3, 0.5), np.full((3, 3), 0.5), np.full((3, 3), 0.5) + 20 * np.eye(3)
    for r in before.groupBy("before", "gap", "role").count().collect():
        if r["before"] is None:
            first[code[r["role"]]] += r["count"]
        else:
            (following if r["gap"] else within)[code[r["before"]], code[r["role"]]] += r["count"]
    logs = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return ChatModel(logs(first), logs(following), {n: logs(x) for n, x in features.items()}, logs(within))


def _scores(model: ChatModel, columns: dict[str, Column]) -> Column:
    """Log probability of a line's features by role."""
    each = []
    for r in range(len(ROLES)):
        terms = [F.element_at(F.array(*map(F.lit, map(float, model.features[n][r]))), c + 1) for n, c in columns.items()]
        each.append(sum(terms[1:], terms[0]))
    return F.array(*each)


def _by_group(df: DataFrame, keys: list[str], order: list[str], work, schema: str) -> DataFrame:
    """Call work(frame, edges) on frames that hold whole groups of `keys`, their rows in order; edges are where groups begin, and the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            last = (batch[keys].to_numpy() == batch[keys].iloc[-1].to_numpy()).all(1)
            n = len(batch) - int(last.sum())
            if n:
                yield work(*_grouped(pd.concat([*held[:-1], batch.iloc[:n]], ignore_index=True), keys))
                held = [batch.iloc[n:]]
        if held:
            yield work(*_grouped(pd.concat(held, ignore_index=True), keys))
        held.clear()
        give_back()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def _grouped(frame: pd.DataFrame, keys: list[str]) -> tuple[pd.DataFrame, np.ndarray]:
    k = frame[keys].to_numpy()
    return frame, np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1, len(k)]


def _ranks(edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(groups, their rows) for the first row of every group, then the second of those that have one, and so on."""
    size, k = np.diff(edges), 0
    while len(groups := np.flatnonzero(size > k)):
        yield groups, edges[groups] + k
        k += 1


def _composed(t: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Best score of each group by the role before it (or none, the last row) and its last role; t has those of its parts."""
    out = np.empty((len(edges) - 1, 4, 3))
    for k, (g, at) in enumerate(_ranks(edges)):
        out[g] = t[at] if not k else (out[g][:, :, :, None] + t[at][:, None, :3]).max(2)
    return out


def _traced(t: np.ndarray, edges: np.ndarray, before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The last role of each part on the best path from role `before` (3: none) to role `last` (-1: the best) of its group."""
    n = len(edges) - 1
    delta, back, steps = np.empty((n, 3)), np.zeros((len(t), 3), np.int64), list(_ranks(edges))
    for k, (g, at) in enumerate(steps):
        if not k:
            delta[g] = t[at, before[g]]
            continue
        through = delta[g][:, :, None] + t[at][:, :3]
        back[at] = through.argmax(1)
        delta[g] = through.max(1)
    role = np.where(last < 0, delta.argmax(1), last)
    ends = np.empty(len(t), np.int64)
    for _, (g, at) in reversed(list(enumerate(steps))):
        ends[at] = role[g]
        role[g] = back[at, role[g]]
    return ends


def _before(ends: np.ndarray, edges: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The role before each part."""
    out = np.r_[0, ends[:-1]]
    out[edges[:-1]] = before
    return out


def parse_chat(lines: DataFrame, model: ChatModel, other: ChatModel | None = None) -> DataFrame:
    """One row per input row: conv_id, turn, line, role, turn_no, rendered.

    lines has conv_id, turn and, where there is one, line (order in the conversation; ties in text order), text and,
    where there is one, gap (a blank line is before it; without the column all have one); a column role is not read, nor are
    others. conv_id may be of any type that has an order, turn and line are whole numbers. With `other`, half of the
    conversations, by model_of, are decoded by it. role is the likeliest path's (Viterbi over the whole conversation).
    Lines in a row with one role make a turn; turn_no counts from 0. rendered is the line without its speaker marker, at the
    start of a turn after a tag that opens it (and closes the turn before), so a conversation's rows in order are its
    canonical text. Null texts count as empty. Rows without conv_id or turn are conversations of one line. An empty table
    gives an empty table.

    Lines are sorted over all tasks and numbered, then decoded in groups of at most 32, groups of those, and partitions: each
    becomes a table of best scores between the roles before and at its end, and is traced back between the roles found
    above it. So a conversation of any length is spread over tasks, no group is larger than 2**18 tables, and the path is exact.
    """
    ship(lines.sparkSession)
    models = [model, other or model]
    seen = _features(F.col("text"))
    bare = F.coalesce("text", F.lit(""))
    for role in ROLES:
        bare = F.when(seen["marker"] == ROLES.index(role) + 1, F.regexp_replace(F.coalesce("text", F.lit("")), _OPEN.format(MARKERS[role]), "")).otherwise(bare)
    line = F.col("line") if "line" in lines.columns else F.lit(None)
    gap = F.coalesce("gap", F.lit(True)) if "gap" in lines.columns else F.lit(True)
    half = model_of(F.col("conv_id")) if other else F.lit(0)
    score = F.when(half == 1, _scores(models[1], seen)).otherwise(_scores(models[0], seen)) if other else _scores(model, seen)
    scored = lines.select("conv_id", F.col("turn").cast("long").alias("turn"), line.cast("long").alias("line"), (gap | (seen["marker"] > 0)).alias("gap"), half.alias("half"), score.alias("score"), F.xxhash64("text").alias("tie"), bare.alias("bare"))
    placed = scored.where("conv_id is not null and turn is not null").orderBy("conv_id", "turn", "line", "tie")
    # sorted over all partitions, so a number is a place: partition, then row
    placed = cut(placed.withColumn("at", F.monotonically_increasing_id()).drop("tie"))
    conv = f"conv_id {lines.schema['conv_id'].dataType.simpleString()}"
    table = f"{conv}, at long, best array<double>"
    steps = np.array([[m.within, m.following] for m in models])
    starts = np.array([m.first for m in models])

    def line_tables(g: pd.DataFrame) -> np.ndarray:
        e, own = np.stack(g["score"].values), g["half"].values
        t = np.concatenate([steps[own, g["gap"].values.astype(int)], starts[own][:, None]], 1)
        return t + e[:, None]

    def group(level: int, name: str = "at"):
        return F.shiftrightunsigned(name, _LEVELS[level])

    def lowest(g: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"conv_id": g["conv_id"].values[edges[:-1]], "at": g["at"].values[edges[:-1]], "best": list(_composed(line_tables(g), edges).reshape(-1, 12))})

    def higher(g: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
        t = np.stack(g["best"].values).reshape(-1, 4, 3) if len(g) else np.empty((0, 4, 3))
        return pd.DataFrame({"conv_id": g["conv_id"].values[edges[:-1]], "at": g["at"].values[edges[:-1]], "best": list(_composed(t, edges).reshape(-1, 12))})

    tables = [cut(_by_group(placed.select("conv_id", "at", "gap", "half", "score", group(0).alias("part")), ["conv_id", "part"], ["at"], lowest, table))]
    for level in (1, 2):
        tables.append(cut(_by_group(tables[-1].withColumn("part", group(level)), ["conv_id", "part"], ["at"], higher, table)))

    def descend(g: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
        before, last = g["before"].values[edges[:-1]].astype(np.int64), g["last"].values[edges[:-1]].astype(np.int64)
        ends = _traced(np.stack(g["best"].values).reshape(-1, 4, 3), edges, before, last)
        return pd.DataFrame({"conv_id": g["conv_id"].values, "at": g["at"].values, "before": _before(ends, edges, before), "last": ends})

    path = _by_group(tables[2].select("*", F.lit(3).alias("before"), F.lit(-1).alias("last")), ["conv_id"], ["at"], descend, f"{conv}, at long, before int, last int")
    for level in (2, 1):
        known = cut(path).select("conv_id", group(level).alias("part"), "before", "last")
        path = _by_group(tables[level - 1].withColumn("part", group(level)).join(known, ["conv_id", "part"]), ["conv_id", "part"], ["at"], descend, f"{conv}, at long, before int, last int")
    known = cut(path).select("conv_id", group(0).alias("part"), "before", "last")

    def lines_of(g: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
        before, last = g["before"].values[edges[:-1]].astype(np.int64), g["last"].values[edges[:-1]].astype(np.int64)
        ends = _traced(line_tables(g), edges, before, last)
        opens = _before(ends, edges, before) != ends
        opened = np.cumsum(opens)
        opened -= np.repeat((opened - opens)[edges[:-1]], np.diff(edges))
        return pd.DataFrame({"conv_id": g["conv_id"].values, "at": g["at"].values, "turn": g["turn"].values, "line": g["line"].astype("Int64"), "role_no": ends, "opens": opens, "opened": opened, "bare": g["bare"].values})

    traced = cut(_by_group(placed.withColumn("part", group(0)).join(known, ["conv_id", "part"]), ["conv_id", "part"], ["at"], lines_of, f"{conv}, at long, turn long, line long, role_no int, opens boolean, opened long, bare string"))
    # turns opened before a group: within its group of groups, and before that
    opened = cut(traced.groupBy("conv_id", group(0).alias("part")).agg(F.max("opened").alias("n"), F.min("at").alias("at")))
    above = opened.groupBy("conv_id", group(1).alias("upper")).agg(F.sum("n").alias("n"))
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    above = above.select("conv_id", "upper", F.coalesce(F.sum("n").over(earlier("conv_id", "upper")), F.lit(0)).alias("far"))
    near = opened.select("conv_id", "part", group(1).alias("upper"), F.coalesce(F.sum("n").over(Window.partitionBy("conv_id", group(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("near"))
    turns_before = near.join(above, ["conv_id", "upper"]).select("conv_id", "part", (F.col("near") + F.col("far")).alias("turns_before"))
    out = traced.withColumn("part", group(0)).join(turns_before, ["conv_id", "part"]).select("conv_id", "turn", "line", "role_no", "opens", (F.col("turns_before") + F.col("opened") - 1).alias("turn_no"), "bare")
    alone = F.when(F.col("half") == 1, F.zip_with("score", F.array(*map(F.lit, map(float, starts[1]))), lambda a, b: a + b)).otherwise(F.zip_with("score", F.array(*map(F.lit, map(float, starts[0]))), lambda a, b: a + b))
    single = scored.where("conv_id is null or turn is null").select("conv_id", "turn", "line", (F.array_position(alone, F.array_max(alone)) - 1).cast("int").alias("role_no"), F.lit(True).alias("opens"), F.lit(0).cast("long").alias("turn_no"), "bare")
    out = out.unionByName(single)
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("role_no") + 1)
    tag = F.concat(F.when(F.col("turn_no") > 0, "<|im_end|>\n").otherwise(""), F.lit("<|im_start|>"), role, F.lit("\n"))
    return out.select("conv_id", "turn", "line", role.alias("role"), "turn_no", F.concat(F.when(F.col("opens"), tag).otherwise("\n"), F.col("bare")).alias("rendered"))


def model_of(conv_id: Column) -> Column:
    """Which half a conversation is in, 0 or 1."""
    return F.when(conv_id.isNull(), 0).otherwise(F.pmod(F.xxhash64(F.lit(12), conv_id.cast("string")), F.lit(2)).cast("int"))


def chat_format(turns: DataFrame) -> DataFrame:
    """parse_chat over the lines of whole conversations: conv_id, turn (the row's own), line (in it), role, turn_no, rendered.

    Each half of the conversations is decoded with a model of the other half's roles, so no conversation's own roles are read.
    """
    lines = turn_lines(turns)
    half = model_of(F.col("conv_id"))
    return parse_chat(lines, fit_chat(lines.where(half == 1)), fit_chat(lines.where(half == 0)))
