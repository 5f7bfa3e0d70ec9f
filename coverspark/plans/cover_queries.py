"""Standardising covers and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverspark.functions import numbers as N
from coverspark.functions import text as T
from coverspark.operators import cover as C
from coverspark.operators import match as M
from coverspark.plans.registry import COVER, VISITS, ctes, query, table
from coverspark.session import ship

_CODE = "CASE line WHEN 1 THEN '-9' WHEN 2 THEN ' ' WHEN 3 THEN '*' WHEN 4 THEN 'None' ELSE CAST(CAST(cover AS INT) AS VARCHAR({0})) END"
_SPARK_CODE, _DUCK_CODE = (_CODE.replace("VARCHAR({0})", t) for t in ("STRING", "VARCHAR"))
_PFT = """CASE WHEN habit IS NULL THEN NULL WHEN lower(habit) LIKE '%crust%' THEN 'other' WHEN lower(habit) LIKE '%moss%' THEN 'bryophyte'
  WHEN lower(habit) LIKE '%grass%' THEN 'graminoid' WHEN lower(habit) LIKE '%shrub%' THEN leaf || ' shrub' WHEN lower(habit) LIKE '%tree%' THEN leaf || ' tree' ELSE lower(habit) END"""
#: Habits and leaf retention of the fixture: part types stand for both.
HABITS = """
  SELECT visit_id, species, dataset, line, zone, cover,
         CASE habit WHEN 'ECONOMY' THEN 'Moss' WHEN 'SMALL' THEN 'dwarf shrub' WHEN 'MEDIUM' THEN 'grass-like' WHEN 'LARGE' THEN 'Tree' WHEN 'PROMO' THEN 'soil crust' ELSE 'forb' END AS habit,
         CASE p_size % 4 WHEN 0 THEN 'deciduous' WHEN 2 THEN 'evergreen' END AS leaf
  FROM (""" + COVER + ") c"
PFTS = ["bryophyte", "forb", "graminoid", "other", "deciduous shrub", "evergreen shrub", "deciduous tree", "evergreen tree"]


def with_pft(spark, d):
    return table(spark, d, HABITS).withColumn("pft", T.habit_to_pft(F.col("habit"), F.col("leaf")))


@query(ctes(cover=COVER) + f"SELECT dataset, CASE WHEN trim({_DUCK_CODE}) NOT IN ('-9', '', '*', 'None') THEN {_DUCK_CODE} END AS code, count(*) AS n FROM cover GROUP BY ALL")
def null_tokens(spark, d):
    c = table(spark, d, f"SELECT dataset, {_SPARK_CODE} AS code FROM ({COVER}) c")
    return c.withColumn("code", N.null_tokens(F.col("code"))).groupBy("dataset", "code").agg(F.count("*").alias("n"))


@query(ctes(cover=COVER) + """
  SELECT scale, code, round(CASE scale || ':' || code WHEN 'hult_sernander:1' THEN 4 WHEN 'hult_sernander:2' THEN 9 WHEN 'hult_sernander:3' THEN 18 WHEN 'hult_sernander:4' THEN 38 WHEN 'hult_sernander:5' THEN 63 WHEN 'hult_sernander:6' THEN 87
    WHEN 'westhoff_maarel:1' THEN 0.05 WHEN 'westhoff_maarel:2' THEN 1 WHEN 'westhoff_maarel:3' THEN 2.5 WHEN 'westhoff_maarel:4' THEN 4.5 WHEN 'westhoff_maarel:5' THEN 9 WHEN 'westhoff_maarel:6' THEN 18.5 WHEN 'westhoff_maarel:7' THEN 37
    WHEN 'braun_blanquet:1' THEN 3 WHEN 'braun_blanquet:2' THEN 15 WHEN 'braun_blanquet:3' THEN 37.5 WHEN 'braun_blanquet:4' THEN 62.5 WHEN 'braun_blanquet:5' THEN 87.5
    ELSE try_cast(code AS DOUBLE) END, 6) AS pct, count(*) AS n
  FROM (SELECT CASE dataset WHEN '1-URGENT' THEN 'hult_sernander' WHEN '2-HIGH' THEN 'westhoff_maarel' WHEN '3-MEDIUM' THEN 'braun_blanquet' ELSE 'percent' END AS scale, CAST(line AS VARCHAR) AS code FROM cover) GROUP BY ALL""")
def code_to_percent(spark, d):
    c = table(spark, d, COVER).select(F.expr("CASE dataset WHEN '1-URGENT' THEN 'hult_sernander' WHEN '2-HIGH' THEN 'westhoff_maarel' WHEN '3-MEDIUM' THEN 'braun_blanquet' ELSE 'percent' END").alias("scale"), F.col("line").cast("string").alias("code"))
    return N.codes_to_percent(c).groupBy("scale", "code", F.round("pct", 6).alias("pct")).agg(F.count("*").alias("n"))


#: Cells and what becomes of them.
_CELLS = [
    ("--+", "+"), ("+ on slope", "+"), (" + ", "+"), ("0,.5", "0.5"), ("0,75", "0.5"), ("0,x5", "0.5"), ("0.,5", "0.5"), ("  ", None), ("4 (5)", "5"), ("5(6)", "6"), ("2 ( 3)", "3"), ("3 (4 )", "4"), ("1 (2)", "2"), ("4 ??", "4"),
    ("4 ?", "4 ?"), ("›6", "6"), ("›3", "3"), ("2a", "2"), ("2B", "2"), ("?", None), ("2 ?", "2"), ("10 crust", "10"), ("0.0", "0"), ("6.0", "6"), ("7.0", "7.0"), ("¨+", "+"), ("x+Â\xa0y", "x+y"), ("-10", None), ("?1", "1"), ("I", "1"), ("3", "3"),
]
_PICK = "CASE p_partkey % {n} {whens} END"
_RAW = _PICK.format(n=len(_CELLS), whens=" ".join(f"WHEN {k} THEN '{raw}'" for k, (raw, _) in enumerate(_CELLS)))
_CLEANED = _PICK.format(n=len(_CELLS), whens=" ".join(f"WHEN {k} THEN " + (f"'{code}'" if code is not None else "NULL") for k, (_, code) in enumerate(_CELLS)))


@query(ctes(cover=COVER) + f"SELECT {_RAW} AS raw, {_CLEANED} AS code, count(*) AS n FROM cover GROUP BY ALL")
def dirty_code_repair(spark, d):
    c = table(spark, d, f"SELECT {_RAW} AS raw FROM ({COVER}) c")
    return c.withColumn("code", N.repair_code(F.col("raw"))).groupBy("raw", "code").agg(F.count("*").alias("n"))


@query(ctes(cover=COVER) + "SELECT dataset, round(sum(CASE WHEN cover - line = 0 THEN 0.05 ELSE cover - line END), 6) AS total FROM cover GROUP BY dataset")
def trace_rule(spark, d):
    return table(spark, d, COVER).groupBy("dataset").agg(F.round(F.sum(N.trace(F.col("cover") - F.col("line"))), 6).alias("total"))


@query(ctes(h=HABITS) + f"SELECT habit, leaf, {_PFT} AS pft, count(*) AS n FROM h GROUP BY ALL")
def habit_to_pft(spark, d):
    return with_pft(spark, d).groupBy("habit", "leaf", "pft").agg(F.count("*").alias("n"))


@query(ctes(h=HABITS) + f"SELECT visit_id, {_PFT} AS pft, round(sum(cover), 6) AS cover FROM h GROUP BY ALL")
def pft_sum(spark, d):
    return C.sum_cover(with_pft(spark, d), ["visit_id", "pft"], "cover").withColumn("cover", F.round("cover", 6))


@query(ctes(h=HABITS) + f"SELECT visit_id, {_PFT} AS pft, round(coalesce(sum(cover), 0), 6) AS cover FROM h GROUP BY ALL")
def pft_sum_zero_filled(spark, d):
    return C.sum_cover(with_pft(spark, d), ["visit_id", "pft"], "cover", zero_filled=True).withColumn("cover", F.round("cover", 6))


@query(ctes(h=HABITS) + "SELECT visit_id, " + ", ".join(f"sum(cover) FILTER ({_PFT} = '{p}') AS \"{p}\"" for p in PFTS) + " FROM h GROUP BY visit_id")
def pft_pivot(spark, d):
    return C.pivot_cover(with_pft(spark, d), "visit_id", "pft", PFTS, "cover")


_TWO = f"SELECT visit_id, sum(cover) FILTER ({_PFT} = 'bryophyte') AS bryophyte, sum(cover) FILTER ({_PFT} = 'other') AS lichen FROM h GROUP BY visit_id"


@query(ctes(h=HABITS) + f"SELECT visit_id, coalesce(bryophyte, 0) + coalesce(lichen, 0) AS nonvascular, bryophyte + lichen AS strict FROM ({_TWO})")
def nonvascular_sum(spark, d):
    wide = C.pivot_cover(with_pft(spark, d), "visit_id", "pft", ["bryophyte", "other"], "cover")
    b, o = F.col("bryophyte"), F.col("other")
    return wide.select("visit_id", N.sum_skipping_nulls(b, o).alias("nonvascular"), (b + o).alias("strict"))


@query(ctes(h=HABITS) + f"SELECT visit_id, CASE WHEN coalesce(bryophyte, lichen) IS NOT NULL THEN coalesce(bryophyte, 0) + coalesce(lichen, 0) END AS ground FROM ({_TWO})")
def same_name_sum(spark, d):
    wide = C.pivot_cover(with_pft(spark, d), "visit_id", "pft", ["bryophyte", "other"], "cover")
    return C.merge_columns(wide, "ground", ["bryophyte", "other"]).select("visit_id", "ground")


@query("""SELECT p_partkey, column_name, value FROM (
  SELECT p_partkey, 'p_size' AS column_name, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL
  SELECT p_partkey, 'p_retailprice', p_retailprice FROM part UNION ALL SELECT p_partkey, 'p_brand', 0 FROM part)""")
def unpivot_matrix(spark, d):
    return C.unpivot_matrix(table(spark, d, "SELECT * FROM part"), ["p_partkey"], ["p_size", "p_retailprice", "p_brand"], "column_name", "value", 0.0)


@query("SELECT CAST(NULL AS DOUBLE) AS water_cover, CAST(p_size AS DOUBLE) AS shrub_cover, CAST(NULL AS DOUBLE) AS moss_cover, p_partkey FROM part")
def std_columns(spark, d):
    p = table(spark, d, "SELECT p_partkey, CAST(p_size AS DOUBLE) AS shrub_cover FROM part")
    return C.with_columns_of(p, ["water_cover", "shrub_cover", "moss_cover"])


@query(ctes(v=VISITS) + """SELECT source, tag, count(*) AS n, count(price) AS n_price, count(plot) AS n_plot FROM (
  SELECT source, price, NULL AS plot, 'a' AS tag FROM v WHERE method = 'F' UNION ALL SELECT source, NULL, plot, 'b' FROM v WHERE method = 'O') GROUP BY ALL""")
def source_union(spark, d):
    v = table(spark, d, VISITS)
    both = C.union_sources({"a": v.where("method = 'F'").select("source", "price"), "b": v.where("method = 'O'").select("source", "plot")}, "tag")
    return both.groupBy("source", "tag").agg(F.count("*").alias("n"), F.count("price").alias("n_price"), F.count("plot").alias("n_plot"))


@query(ctes(h=HABITS) + "SELECT CASE WHEN habit LIKE '%shrub%' THEN 'shrub' WHEN habit LIKE '%Tree%' THEN 'tree' ELSE 'rest' END AS part, count(*) AS n FROM h GROUP BY ALL")
def habit_split(spark, d):
    h = table(spark, d, HABITS)
    return C.labelled(h, "part", [("shrub", F.col("habit").contains("shrub")), ("tree", F.col("habit").contains("Tree"))], "rest").groupBy("part").agg(F.count("*").alias("n"))


@query(ctes(cover=COVER) + "SELECT line, count(*) AS n, round(sum(cover / nullif(line - 3, 0)), 6) AS total FROM cover WHERE cover / nullif(line - 3, 0) IS NOT NULL GROUP BY line")
def finite_features(spark, d):
    c = table(spark, d, COVER).withColumn("ratio", F.try_divide("cover", F.col("line") - 3))
    return C.finite_rows(c, ["ratio"]).groupBy("line").agg(F.count("*").alias("n"), F.round(F.sum("ratio"), 6).alias("total"))


_TEXTS = "SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' var. ' || lower(p_type) WHEN 2 THEN 'unknown ' || p_name WHEN 3 THEN p_name || ' (Piper) M. Peck' WHEN 4 THEN p_name || ' L.' ELSE split_part(p_name, ' ', 1) || ' species' END AS name FROM part"


@query(ctes(t=_TEXTS) + """SELECT p_partkey, CASE WHEN len(w) = 0 THEN NULL WHEN len(w) < 2 OR w[2] = 'species' OR w[1] = 'species' THEN w[1] WHEN w[1] = 'unknown' THEN w[2] ELSE w[1] || ' ' || w[2] END AS key, w[1] AS genus
  FROM (SELECT p_partkey, string_split_regex(trim(name), '\\s+') AS w FROM t)""")
def genus_species_key(spark, d):
    return table(spark, d, _TEXTS).select("p_partkey", T.genus_species(F.col("name")).alias("key"), T.first_word(F.col("name")).alias("genus"))


_AUTHOR = ", ".join(rf"nullif(regexp_extract(name, '^.*?\s({p}.*)$', 1), '')" for p in (r"\(", r"s\.l\.", r"[A-Z][A-Z]+\.", r"[A-Z][a-z]+\.", r"[A-Z]\."))


@query(ctes(t=_TEXTS) + f"SELECT p_partkey, trim(substr(name, 1, length(name) - length(coalesce({_AUTHOR}, '')))) AS taxon, coalesce({_AUTHOR}, '') AS author FROM t")
def split_author(spark, d):
    return table(spark, d, _TEXTS).withColumn("s", T.split_author(F.col("name"))).select("p_partkey", "s.taxon", "s.author")


_CLEAN = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '\(.*?\)', '', 'g'), '[^a-z\s]', '', 'g'), '\s+', ' ', 'g'))"


@query(ctes(t=_TEXTS) + f"SELECT p_partkey, {_CLEAN} AS clean, array_to_string(string_split({_CLEAN}, ' ')[1:2], ' ') AS as_species FROM t")
def clean_name(spark, d):
    c = F.col("name")
    return table(spark, d, _TEXTS).select("p_partkey", T.clean_name(c).alias("clean"), T.normalize_by_rank(c, F.lit("species")).alias("as_species"))


@query(ctes(t=_TEXTS) + r"""SELECT p_partkey, CASE WHEN list_contains(w, 'var') THEN CASE WHEN list_position(w, 'var') > 2 THEN 'variety' ELSE 'genus' END
  WHEN list_contains(w, 'species') THEN CASE WHEN list_position(w, 'species') > 2 THEN 'subspecies' ELSE 'genus' END WHEN len(w) <= 1 THEN 'genus' WHEN len(w) = 2 THEN 'species' ELSE 'subspecies' END AS rank
  FROM (SELECT p_partkey, regexp_extract_all(lower(name), '\b[a-z]+\b') AS w FROM t)""")
def rank_infer(spark, d):
    return table(spark, d, _TEXTS).select("p_partkey", T.infer_rank(F.col("name")).alias("rank"))


@query(ctes(t=_TEXTS) + r"SELECT p_partkey, CASE WHEN len(w) > 2 THEN array_to_string(w[3:], ' ') END AS author FROM (SELECT p_partkey, string_split_regex(trim(name), '\s+') AS w FROM t)")
def author_by_rank(spark, d):
    return table(spark, d, _TEXTS).select("p_partkey", T.author_by_rank(F.col("name"), F.lit("species")).alias("author"))


_LIST = "SELECT p_name AS name, split_part(p_name, ' ', 1) || ' x' || p_size AS accepted_name, CASE WHEN p_size % 3 > 0 THEN lower(p_type) ELSE '' END AS habit FROM part"
_SPECIES = "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 1) || ' x' || (p_size + 7) ELSE p_name END AS species FROM part"


def _lookup(n, key, source):
    return f"p{n} AS (SELECT {key.format(source)} AS k, nullif(array_to_string(list_sort(list(DISTINCT nullif(trim(habit), '')) FILTER (trim(habit) <> '')), ','), '') AS h FROM checklist GROUP BY 1)"


@query(ctes(checklist=_LIST, s=_SPECIES) + ", " + ", ".join([_lookup(1, "{0}", "accepted_name"), _lookup(2, "{0}", "name"), _lookup(3, "split_part({0}, ' ', 1)", "accepted_name"), _lookup(4, "split_part({0}, ' ', 1)", "name")]) + """
  SELECT p_partkey, species, coalesce(p1.h, p2.h, p3.h, p4.h) AS habit FROM s LEFT JOIN p1 ON p1.k = species LEFT JOIN p2 ON p2.k = species
  LEFT JOIN p3 ON p3.k = split_part(species, ' ', 1) LEFT JOIN p4 ON p4.k = split_part(species, ' ', 1)""")
def habit_cascade(spark, d):
    return M.habit_cascade(table(spark, d, _SPECIES), table(spark, d, _LIST))


@query(ctes(s=_SPECIES) + """SELECT p_partkey, species, coalesce(r, '') AS leaf_retention FROM s LEFT JOIN (
  SELECT split_part(p_name, ' ', 1) AS g, array_to_string(list_sort(list(DISTINCT CASE p_size % 4 WHEN 0 THEN 'deciduous' ELSE 'evergreen' END)), ',') AS r FROM part WHERE p_size % 2 = 0 GROUP BY 1) ON g = split_part(species, ' ', 1)""")
def leaf_retention(spark, d):
    r = table(spark, d, "SELECT p_name AS retention_name, CASE p_size % 4 WHEN 0 THEN 'deciduous' ELSE 'evergreen' END AS retention FROM part WHERE p_size % 2 = 0")
    return M.leaf_retention(table(spark, d, _SPECIES), r)


_NAMES = "SELECT DISTINCT substr(p_name, 1, length(p_name) - 1) AS name, split_part(p_name, ' ', 1) AS block FROM part"
_FUZZY = """pairs AS (SELECT name, c.candidate, round(100.0 * (1 - levenshtein(name, c.candidate) / CAST(greatest(length(name), length(c.candidate), 1) AS DOUBLE)), 6) AS score
    FROM n JOIN (SELECT DISTINCT p_name AS candidate, split_part(p_name, ' ', 1) AS block FROM part) c USING (block)),
  placed AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, candidate) AS place FROM pairs WHERE score >= 50)"""


def _candidates(spark, d, top):
    n, c = table(spark, d, _NAMES), table(spark, d, "SELECT DISTINCT p_name AS candidate, split_part(p_name, ' ', 1) AS block FROM part")
    return M.fuzzy_candidates(n, c, "block", top=top, least=50.0)


@query(ctes(n=_NAMES) + f", {_FUZZY} SELECT name, candidate, score, place FROM placed WHERE place <= 5")
def fuzzy_top5(spark, d):
    return _candidates(spark, d, 5)


@query(ctes(n=_NAMES) + f", {_FUZZY} SELECT name, candidate, score FROM placed WHERE place = 1 AND score >= 85")
def fuzzy_best(spark, d):
    return _candidates(spark, d, 1).where("score >= 85").drop("place")


_FORMS = "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' var. ' || lower(p_type) WHEN 2 THEN p_name || ' ssp. ' || lower(p_type) ELSE split_part(p_name, ' ', 1) END AS n FROM part"
_ASKED = f"SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN n WHEN 1 THEN substr(n, 1, length(n) - 1) ELSE replace(n, 'ssp.', 'var.') END AS name FROM ({_FORMS}) f"
_LISTED = f"SELECT n AS checklist_name, min('acc ' || n) AS accepted_name FROM ({_FORMS}) f GROUP BY n"
_RANK_OF = """CASE WHEN list_contains({w}, 'var') THEN CASE WHEN list_position({w}, 'var') > 2 THEN 'variety' ELSE 'genus' END WHEN list_contains({w}, 'ssp') THEN CASE WHEN list_position({w}, 'ssp') > 2 THEN 'subspecies' ELSE 'genus' END
  WHEN len({w}) <= 1 THEN 'genus' WHEN len({w}) = 2 THEN 'species' ELSE 'subspecies' END"""
_CLEANED_WORDS = r"string_split(trim(regexp_replace(regexp_replace(lower({0}), '[^a-z\s]', '', 'g'), '\s+', ' ', 'g')), ' ')"


def _ranked(name: str, source: str) -> str:
    return f"SELECT *, w[1] AS genus, {_RANK_OF.format(w='w')} AS rank FROM (SELECT *, {_CLEANED_WORDS.format(name)} AS w FROM ({source}) z)"


@query(ctes(a=_ranked("name", _ASKED), l=_ranked("checklist_name", _LISTED)) + """
  , k AS (SELECT genus, rank, array_to_string(w[1 : CASE rank WHEN 'genus' THEN 1 WHEN 'species' THEN 2 ELSE 4 END], ' ') AS candidate, min(checklist_name) AS checklist_name, arg_min(accepted_name, checklist_name) AS accepted_name FROM l GROUP BY ALL),
  steps AS (SELECT * FROM (VALUES ('subspecies', ['subspecies', 'variety', 'species', 'genus', 'family']), ('variety', ['variety', 'subspecies', 'species', 'genus', 'family']), ('species', ['species', 'subspecies', 'variety', 'genus', 'family']), ('genus', ['genus', 'family'])) t(own_rank, ranks)),
  asked AS (SELECT name, w, genus, a.rank AS own_rank, array_to_string(w, ' ') AS key, unnest(ranks) AS rank, unnest(range(0, len(ranks))) AS step FROM a JOIN steps ON own_rank = a.rank),
  pairs AS (SELECT asked.*, candidate, checklist_name, accepted_name, CASE WHEN key = candidate THEN 100.0 ELSE round(100.0 * (1 - levenshtein(key, candidate) / CAST(greatest(length(key), length(candidate), 1) AS DOUBLE)), 6) END AS score FROM asked JOIN k USING (genus, rank)),
  best AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY step, key <> candidate, score DESC, CASE WHEN own_rank IN ('subspecies', 'variety') AND string_split(name, ' ')[-1] = string_split(candidate, ' ')[-1] THEN 0 ELSE 1 END, candidate) AS r FROM pairs WHERE score >= 85),
  seen AS (SELECT *, row_number() OVER (PARTITION BY name, step ORDER BY score DESC, candidate) AS place FROM pairs),
  told AS (SELECT s.name, array_to_string(list(s.accepted_name || '=' || printf('%.3f', s.score) || '=' || s.rank ORDER BY s.step, s.place), '|') AS audit
    FROM seen s LEFT JOIN best b ON b.name = s.name AND b.r = 1 WHERE place <= 5 AND s.step <= coalesce(b.step, s.step) AND (b.name IS NULL OR b.key <> b.candidate) GROUP BY s.name)
  SELECT a.name, accepted_name, checklist_name, score, best.rank AS rank, coalesce(best.rank = best.own_rank, false) AS rank_match, coalesce(audit, '') AS audit FROM a LEFT JOIN best ON best.name = a.name AND r = 1 LEFT JOIN told ON told.name = a.name""")
def fuzzy_cascade(spark, d):
    told = F.transform("audit", lambda a: F.concat_ws("=", a["accepted_name"], F.format_string("%.3f", a["score"]), a["rank"]))
    return M.fuzzy_cascade(table(spark, d, _ASKED), table(spark, d, _LISTED)).withColumn("audit", F.array_join(told, "|"))


@query()
def fuzzy_cascade_partial(spark, d):
    """The cascade as surveys run it, by the best window of the longer name."""
    ship(spark)
    return M.fuzzy_cascade(table(spark, d, _ASKED), table(spark, d, _LISTED), score=M.partial_score(F.col("key"), F.col("candidate")))


@query()
def fuzzy_partial_ratio(spark, d):
    return M.partial_ratio(_candidates(spark, d, 5).select("name", "candidate"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'umissing' ELSE 'u' || substr(sha1(p_name), 1, 9) END AS uid FROM part")
def uid_hash(spark, d):
    return table(spark, d, "SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_name END AS name FROM part").select("p_partkey", T.hash_id(F.col("name")).alias("uid"))


@query(r"""SELECT p_partkey, lower(regexp_replace(regexp_replace(c, '(.)([A-Z][a-z]+)', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake, CAST(p_size AS VARCHAR) AS whole
  FROM (SELECT p_partkey, p_size, 'coverOf' || replace(p_brand, '#', 'No') || 'XYPlot' AS c FROM part)""")
def label_forms(spark, d):
    p = table(spark, d, "SELECT p_partkey, 'coverOf' || replace(p_brand, '#', 'No') || 'XYPlot' AS c, CAST(CAST(p_size AS DOUBLE) AS STRING) AS n FROM part")
    return p.select("p_partkey", T.camel_to_snake(F.col("c")).alias("snake"), T.int_text(F.col("n")).alias("whole"))
