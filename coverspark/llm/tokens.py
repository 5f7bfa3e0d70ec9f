"""Token ids of whole texts by a public vocabulary, and token counts with overlap resynchronisation."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverspark.llm.texts import map_texts
from coverspark.session import ship

_SPACES = b" \t\n\r\x0b\x0c"
_SPACE, _SOLID, _LETTER, _SIGN, _LEAD, _C3, _LATIN, _HIGH = (np.uint8(1 << k) for k in range(8))


def _kinds(k: int) -> int:
    """What a byte of UTF-8 is, as bits. Signs leave out the apostrophe, which may begin a piece with letters, and the
    bar, which is inside special tokens; _LATIN is the second byte of U+00C0 to U+00FF without the two signs there."""
    sign = 33 <= k <= 126 and not chr(k).isalnum() and chr(k) not in "'|"
    letter = 65 <= k <= 90 or 97 <= k <= 122
    latin = 128 <= k <= 191 and k not in (0x97, 0xB7)
    return sum(int(bit) for bit, is_so in ((_SPACE, k in _SPACES), (_SOLID, 33 <= k <= 126), (_LETTER, letter), (_SIGN, sign), (_LEAD, 0xC3 <= k <= 0xDF), (_C3, k == 0xC3), (_LATIN, latin), (_HIGH, k >= 128)) if is_so)


_KIND = np.array([_kinds(k) for k in range(256)], np.uint8)
_KNOWN = 200_000


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _library(name: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    t.no_truncation()
    t.no_padding()
    return t


def _cuts(b: np.ndarray) -> np.ndarray:
    """Places where a byte-level pre-tokenizer ends a piece whatever stands around.

    These are places before a white-space byte that follows a character which is surely not white space (a piece
    takes white space only at its start), and before a sign that follows a letter (a piece with letters ends at
    anything else). So the ids left and right of such a place do not depend on each other.
    """
    if len(b) < 2:
        return np.empty(0, np.int64)
    kind = _KIND[b]
    solid, letter = (kind[:-1] & _SOLID) != 0, (kind[:-1] & _LETTER) != 0
    solid[1:] |= ((kind[1:-1] & _HIGH) != 0) & ((kind[:-2] & _LEAD) != 0)  # two-byte characters from U+00C0 on
    letter[1:] |= ((kind[1:-1] & _LATIN) != 0) & ((kind[:-2] & _C3) != 0)
    return np.flatnonzero((((kind[1:] & _SPACE) != 0) & solid) | (((kind[1:] & _SIGN) != 0) & letter)) + 1


@lru_cache(maxsize=4)
def _ranks(name: str):
    """The same vocabulary for the `tiktoken` library, and the bytes of each id; None where there is none."""
    import base64
    import os

    import public_tokenizers
    import tiktoken

    place = vocabulary(name.removesuffix(".json") + ".tiktoken")
    if not name.endswith(".json") or not os.path.exists(place):
        return None
    with open(place, "rb") as lines:
        ranks = {base64.b64decode(a): int(k) for a, k in map(bytes.split, lines)}
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, k in ranks.items():
        length[k] = len(piece)
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), length


class Encoder:
    """Ids as the `tokenizers` library gives them, each different unit between two cuts encoded once.

    Units go through `tiktoken` where it has the same vocabulary (the faster of the two), others, and those that
    may hold special tokens, through `tokenizers`. Holds 200,000 units at most and starts anew beyond. For byte-level
    vocabularies without a normalizer.
    """

    def __init__(self, name: str):
        self.library, self.ranks = _library(name), _ranks(name)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.start, self.ids, self.total = [0], [], 0

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.ids) > 1:
            self.ids = [np.concatenate(self.ids)]
        return np.array(self.start), self.ids[0] if self.ids else np.empty(0, np.uint32)

    def _units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of its entry for each unit, number of units of each text)"""
        data = b"".join(texts)
        b = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        first = np.zeros(len(b), bool)
        first[_cuts(b)] = True
        first[[0, *ends[ends < len(b)]] if len(b) else []] = True
        at = np.flatnonzero(first)
        offsets = np.r_[at, len(b)].astype(np.int32) if len(b) else np.zeros(1, np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = units.dictionary_encode()
        at_unit = np.frombuffer(coded.dictionary.buffers()[1], np.int32, len(coded.dictionary) + 1).tolist()
        held = coded.dictionary.buffers()[2].to_pybytes() if len(at) else b""
        different = [held[x:y] for x, y in zip(at_unit, at_unit[1:])]
        if len(self.known) + len(different) > _KNOWN:
            self._forget()
        self._learn([u for u in different if u not in self.known])
        entry = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
        counts = np.diff(np.searchsorted(at, np.r_[0, ends])) if len(b) else np.zeros(len(texts), np.int64)
        return entry[coded.indices.to_numpy(zero_copy_only=False)] if len(at) else np.empty(0, np.int64), counts

    def _learn(self, units: list[bytes]) -> None:
        if self.ranks:  # one call for all units that begin with white space and end with none: they stay apart when joined
            encoding, length = self.ranks
            apart = [u for u in units if u[0] in _SPACES and (33 <= u[-1] <= 126 or (u[-1] >= 128 and 0xC3 <= u[-2] <= 0xDF)) and b"<|" not in u]
            joined = encoding.encode_to_numpy(b"".join(apart).decode("utf-8")).astype(np.uint32)
            ends = np.searchsorted(np.cumsum(length[joined]), np.cumsum([len(u) for u in apart])) + 1 if apart else []
            self._add(apart, joined, ends)
            units = [u for u in units if u not in self.known]
        for a in range(0, len(units), 4096):
            part = units[a : a + 4096]
            got = [e.ids for e in self.library.encode_batch_fast([u.decode("utf-8") for u in part], add_special_tokens=False)]
            self._add(part, np.array([k for ids in got for k in ids], np.uint32), np.cumsum([len(ids) for ids in got]))

    def _add(self, units: list[bytes], ids: np.ndarray, ends) -> None:
        first = len(self.start) - 1
        self.known.update(zip(units, range(first, first + len(units))))
        self.ids.append(ids)
        self.start.extend((np.asarray(ends, np.int64) + self.total).tolist())
        self.total += len(ids)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null counts as empty."""
        return self.encode_bytes([_utf8(t) for t in texts])

    def encode_bytes(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts in UTF-8."""
        entry, units = self._units(texts)
        start, ids = self._tables()
        first, n = start[entry], start[entry + 1] - start[entry]
        total = np.r_[0, np.cumsum(n)]
        flat = ids[np.arange(total[-1]) + np.repeat(first - total[:-1], n)]
        bounds = total[np.r_[0, np.cumsum(units)]]
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def count(self, texts: list[str | None]) -> list[int]:
        entry, units = self._units([_utf8(t) for t in texts])
        start = np.array(self.start)
        total = np.r_[0, np.cumsum(start[entry + 1] - start[entry])]
        return np.diff(total[np.r_[0, np.cumsum(units)]]).tolist()


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def groups(texts: list[str | None], size: int = 1 << 22) -> list[tuple[int, int]]:
    """Runs of texts of about `size` characters, so that arrays over their bytes stay small."""
    out, start, held = [], 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t or "") > size:
            out.append((start, k))
            start, held = k, 0
        held += len(t or "")
    return [*out, (start, len(texts))] if texts else []


@lru_cache(maxsize=4)
def _token_bytes(name: str) -> np.ndarray:
    """Bytes of text that each id stands for; a byte-level vocabulary writes one character per byte."""
    library = _library(name)
    length = np.zeros(library.get_vocab_size(with_added_tokens=True), np.int64)
    for piece, k in library.get_vocab(with_added_tokens=True).items():
        length[k] = len(piece)
    for k, token in library.get_added_tokens_decoder().items():
        length[k] = len(token.content.encode())
    return length


class Splicer:
    """Token counts of texts of any length, from chunks that overlap and are spliced where their encodings agree.

    Chunk k holds bytes k * chunk to (k + 1) * chunk + overlap, moved back to the start of a character. Each is encoded by
    itself, and every token's end is known as an offset in the text. Neighbours are spliced at the first end that both have
    and that is stable (_cuts: a token ends there whatever stands around): tokens up to it are counted in the left chunk,
    those after it in the right one. Where the overlap holds no such place it is doubled until it does, or until the left
    chunk reaches the end of the text, so a text without such places is encoded whole.
    """

    def __init__(self, name: str, chunk: int = 4096, overlap: int = 256):
        self.own, self.length, self.chunk, self.overlap = Encoder(name), _token_bytes(name), chunk, overlap
        self.run = max(1, (1 << 22) // (chunk + overlap))

    def _chunk(self, data: bytes, k: int) -> tuple[int, int]:
        return _whole(data, k * self.chunk), _whole(data, (k + 1) * self.chunk + self.overlap)

    def _ends(self, parts: list[tuple[bytes, int, int]]) -> list[np.ndarray]:
        """Where the tokens of data[a:b] end, for each (data, a, b)."""
        ids = self.own.encode_bytes([data[a:b] for data, a, b in parts])
        return [a + np.cumsum(self.length[i]) for (_, a, _), i in zip(parts, ids)]

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text, in UTF-8."""
        parts = [(k, i) for k, t in enumerate(texts) for i in range(min(self.run, max(1, -(-(len(t) - self.overlap) // self.chunk))))]
        ends = self._ends([(texts[k], *self._chunk(texts[k], i)) for k, i in parts])
        known: list[dict[int, np.ndarray]] = [{} for _ in texts]
        for (k, i), e in zip(parts, ends):
            known[k][i] = e
        return [self._spliced(t, own) for t, own in zip(texts, known)]

    def _spliced(self, data: bytes, known: dict[int, np.ndarray]) -> int:
        total, counted, k = 0, 0, 0
        (start, stop), left = self._chunk(data, 0), known[0]
        while stop < len(data):
            # the last chunk that begins an overlap or more before the left one ends
            k = max(k + 1, (stop - self.overlap) // self.chunk)
            at, end = self._chunk(data, k)
            if k not in known:
                known.clear()  # of a huge text only a run of chunks is held
                run = [j for j in range(k, k + self.run) if j * self.chunk < len(data)]
                known.update(zip(run, self._ends([(data, *self._chunk(data, j)) for j in run])))
            right, width = known[k], self.overlap
            while (place := self._agreed(data, left, right, max(at + 1, counted), min(stop, end))) is None and stop < len(data):
                width *= 2
                stop, end = _whole(data, max(stop, at + width)), _whole(data, max(end, at + 2 * width))
                left, right = self._ends([(data, start, stop), (data, at, end)])
            if place is None:
                break
            total += int(np.searchsorted(left, place, "right") - np.searchsorted(left, counted, "right"))
            counted, start, stop, left = place, at, end, right
        return total + int(len(left) - np.searchsorted(left, counted, "right"))

    @staticmethod
    def _agreed(data: bytes, left: np.ndarray, right: np.ndarray, after: int, before: int) -> int | None:
        """The first stable place after `after` and before `before` where tokens of both end."""
        if before <= after:
            return None
        low = max(0, after - 2)  # two bytes back are all that decides whether a place is stable
        stable = low + _cuts(np.frombuffer(data, np.uint8, before - low, low))
        stable = stable[stable > after]
        for ends in (left, right):
            found = np.searchsorted(ends, stable)
            stable = stable[(found < len(ends)) & (ends[np.minimum(found, len(ends) - 1)] == stable)] if len(ends) else stable[:0]
        return int(stable[0]) if len(stable) else None


def _whole(data: bytes, at: int) -> int:
    """The start of the character at this byte, or the end of the text."""
    if at >= len(data):
        return len(data)
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def count_spliced(text: str, name: str, chunk: int = 4096, overlap: int = 256) -> int:
    """Tokens of one text of any length, by a Splicer."""
    return Splicer(name, chunk, overlap).count([_utf8(text)])[0]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "byte_bpe_50k.json", limit: int = 1024, chunk: int = 4096, overlap: int = 256) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Whole texts, as the library counts them without added tokens, truncation or padding; null counts as empty (0). Every
    text goes through a Splicer; one of at most a chunk and an overlap is a single chunk. Ids may be null or repeated;
    other columns are ignored; an empty table gives an empty table. A map: no shuffle.
    """
    ship(docs.sparkSession)

    def make():
        own = Splicer(name, chunk, overlap)

        def of(texts: list[str | None]) -> dict[str, list]:
            data = [_utf8(t) for t in texts]
            return {"n_bytes": [len(d) for d in data], "n_tokens": [n for a, b in groups(texts) for n in own.count(data[a:b])]}

        return of

    counted = map_texts(docs.select(F.col(id_col), F.col(text_col).alias("_text")), "_text", make, {"n_bytes": pa.int64(), "n_tokens": pa.int64()})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
