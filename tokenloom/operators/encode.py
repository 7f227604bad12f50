"""Encoding and decoding of documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.functions.codepoints import code_points, encoded_slices, id_lists, spread, table_of
from tokenloom.functions.lookup import constant_array
from tokenloom.functions.normalize import nfkc
from tokenloom.operators.packedwords import PairTable, Symbols, merged_words
from tokenloom.operators.vocab import BYTE_BASE, EOS_ID, UNK_ID, Subwords

# Fixed value: the literal that a prompt may hold for the end-of-text id.
END_OF_TEXT = "<|endoftext|>"


def char_ids(text: Column, ids: dict[str, int], on_unknown: str = "error") -> Column:
    """Ids of the characters of a text. Unknown ones raise, or become the unknown id with `on_unknown="unk"`."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = table_of(ids)

        def look_up(points: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
            found = table[points]
            if found.size and found.min() < 0:
                if on_unknown != "unk":
                    raise ValueError("character outside the vocabulary")
                found = np.where(found < 0, UNK_ID, found)
            return id_lists(found, sizes)

        for texts in batches:
            yield encoded_slices(texts, look_up)

    return encode(text)


def literal_pattern(specials: Iterable[str]) -> str:
    """Pattern of the literals, longest first, so that the leftmost, longest one is found."""
    escaped = ["".join(c if c.isalnum() else f"\\{c}" for c in s) for s in sorted(specials, key=len, reverse=True)]
    return "|".join(escaped)


def char_ids_with_special(text: Column, ids: dict[str, int], special_id: int) -> Column:
    """Like `char_ids`, but the end-of-text literal becomes `special_id`; other unknown characters become -1."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = table_of(ids)
        # A code point that no text holds stands for the literal.
        mark = "\U0010ffff"
        table[ord(mark)] = special_id
        for texts in batches:
            marked = pc.replace_substring(texts, END_OF_TEXT, mark)
            yield encoded_slices(marked, lambda points, sizes: id_lists(table[points], sizes))

    return encode(text)


def char_ids_or_bytes(text: Column, ids: dict[str, int]) -> Column:
    """Ids of the characters of a text; a character outside the alphabet gives the ids of its bytes."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = table_of(ids)

        def look_up(points: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
            found = table[points]
            outside = np.flatnonzero(found < 0)
            # Ids of every distinct outside character, one after the other.
            strange, which = np.unique(points[outside], return_inverse=True)
            spelled = [[BYTE_BASE + b for b in chr(p).encode()] for p in strange]
            lengths = np.ones(len(points), np.int64)
            widths = np.array([len(s) for s in spelled], np.int64)
            lengths[outside] = widths[which]
            out = np.repeat(found, lengths)
            flat = np.array([b for s in spelled for b in s], np.int32)
            firsts = np.cumsum(widths) - widths
            starts = np.cumsum(lengths) - lengths
            out[spread(starts[outside], widths[which])] = flat[spread(firsts[which], widths[which])]
            ends = np.append(0, np.cumsum(lengths))[np.cumsum(sizes)]
            return id_lists(out, np.diff(ends, prepend=0))

        for texts in batches:
            yield encoded_slices(texts, look_up)

    return encode(text)


def encode_documents(docs: DataFrame, ids: Column, eos_id: int | None, keep_empty: bool = False) -> DataFrame:
    """`ids` and `len` of every document, with the end-of-text id appended; `text` is dropped.

    An empty document gives no ids at all, or only the end-of-text id with `keep_empty`. Without
    an `eos_id` no document is closed: the ids are those of the text alone.
    """
    closed = ids if eos_id is None else F.array_append(ids, F.lit(eos_id).cast("int"))
    if not keep_empty and eos_id is not None:
        closed = F.when(F.col("text") != "", closed).otherwise(F.array().cast("array<int>"))
    kept = [c for c in docs.columns if c != "text"]
    return docs.select(*kept, closed.alias("ids")).withColumn("len", F.size("ids"))


def merge_unit(unit: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Symbols of a unit after all merges: the lowest rank first, its places from left to right.

    Symbols form a linked list and ranked pairs a heap, so a unit of n characters takes O(n log n).
    """
    parts: list[str | None] = list(unit)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
    heapify(heap)
    while heap:
        rank = heap[0][0]
        places = []
        while heap and heap[0][0] == rank:
            places.append(heappop(heap)[1])
        fresh = []
        for i in places:
            j = after[i]
            if parts[i] is None or j >= len(parts) or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            fresh.append(i)
        # The pairs around this rank's merges count once all of its places are merged.
        for i in fresh:
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(parts) and (parts[left], parts[right]) in ranks:
                    heappush(heap, (ranks[parts[left], parts[right]], left))
    return [p for p in parts if p is not None]


# Opens the unit of a special literal. It is white space, so that no unit of a text holds it.
SPECIAL_MARK = "\x1d"


def units_with_specials(text: Column, specials: Iterable[str]) -> Column:
    """Units of a text whose special literals, the leftmost and longest first, are units of their own."""
    pattern = literal_pattern(specials)
    parts = F.transform(F.split(text, pattern), T.units)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda s: F.concat(F.lit(SPECIAL_MARK), s))
    turns = F.zip_with(parts, F.array_append(found, F.lit("")), lambda part, special: F.concat_ws(" ", part, special))
    return F.trim(F.regexp_replace(F.array_join(turns, " "), " +", " "))


# Units of more characters are merged one by one: an array pass takes one rank of every unit, so a long one takes many.
LONG_UNIT = 64


class UnitMerger:
    """Ids of units: those of ordinary length are merged together, as arrays."""

    def __init__(self, model: Subwords, specials: Mapping[str, int]):
        self.specials = specials
        self.ranks = {pair: i for i, pair in reversed(list(enumerate(model.merges)))}
        self.ids = model.piece_ids()
        symbols = Symbols()
        self.fresh = np.array([symbols.add(left + right) for left, right in model.merges], np.int32)
        for side in (side for pair in self.ranks for side in pair if len(side) > 1):
            symbols.add(side)
        self.table = PairTable([symbols.key(*pair) for pair in self.ranks], list(self.ranks.values()), len(symbols.merged))
        self.id_of = np.append(table_of({p: i for p, i in self.ids.items() if len(p) == 1}), [self.ids.get(p, -1) for p in symbols.merged])

    def spelled(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [BYTE_BASE + b for b in piece.encode()]

    def one(self, unit: str) -> np.ndarray:
        if unit[:1] == SPECIAL_MARK:
            return np.array([self.specials[unit[1:]]], np.int32)
        return np.array([i for piece in merge_unit(unit, self.ranks) for i in self.spelled(piece)], np.int32)

    def all(self, units: list[str]) -> list[np.ndarray]:
        short = [i for i, u in enumerate(units) if len(u) <= LONG_UNIT and u[:1] != SPECIAL_MARK]
        points, sizes = code_points(pa.array([units[i] for i in short], pa.string()))
        symbols, lengths, order = merged_words((points.astype(np.int32), sizes, np.array(short, np.int64)), self.table, self.fresh)
        found = self.id_of[symbols].astype(np.int32)
        starts = np.cumsum(lengths) - lengths
        out: list[np.ndarray | None] = [None] * len(units)
        for i, start, length in zip(order.tolist(), starts.tolist(), lengths.tolist()):
            out[i] = found[start : start + length]
        # Characters outside the alphabet are spelled by their bytes.
        for i in np.unique(np.repeat(order, lengths)[found < 0]).tolist():
            out[i] = self.one(units[i])
        return [self.one(unit) if ids is None else ids for unit, ids in zip(units, out)]


def subword_encoder(model: Subwords, specials: Mapping[str, int]):
    """Arrow function from space-separated units to ids.

    Units are cut and normalized in the JVM. A batch is dictionary-encoded as a whole: Python sees
    each distinct unit of a batch, merges the distinct units new to a task together, and the id lists are gathered by array.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, np.ndarray] = {}
        merger = UnitMerger(model, specials)
        for batch in batches:
            listed = pc.split_pattern(batch.fill_null(""), " ")
            words = listed.flatten().dictionary_encode()
            units = words.dictionary.to_pylist()
            if len(known) + len(units) > UNIT_CACHE:
                known = {}
            new = [u for u in units if u not in known]
            known.update(zip(new, merger.all(new)))
            lists = [known[u] for u in units]
            sizes = np.array([len(v) for v in lists], np.int64)
            firsts = np.cumsum(sizes) - sizes
            flat = np.concatenate([*lists, np.zeros(0, np.int32)])
            # Every word's ids, one after the other, by position in the distinct units' ids.
            index = words.indices.to_numpy()
            lengths = sizes[index]
            ends = np.cumsum(lengths)
            place = np.repeat(firsts[index] - (ends - lengths), lengths) + np.arange(lengths.sum())
            borders = np.append(0, ends)[listed.offsets.to_numpy() - listed.offsets[0].as_py()]
            yield pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(flat[place], pa.int32()))

    return encode


# Units remembered by one task before it starts over.
UNIT_CACHE = 500_000


def encode_subwords(
    docs: DataFrame,
    model: Subwords,
    eos_id: int | None = EOS_ID,
    compose: bool = False,
    specials: Mapping[str, int] | None = None,
) -> DataFrame:
    """Documents of subword ids: strip, encode, close with the end-of-text id unless that is None.

    `compose` folds compatible characters first (NFKC). Literals of `specials` become their ids; without, they are
    ordinary text.
    """
    body = nfkc(F.coalesce("text", F.lit(""))) if compose else F.col("text")
    cut = docs.withColumn("text", units_with_specials(F.coalesce(body, F.lit("")), specials) if specials else T.units(body))
    encode = subword_encoder(model, dict(specials or {}))
    kept = [c for c in docs.columns if c != "text"]
    encoded = cut.select(*kept, encode(F.col("text")).alias("ids"))
    closed = F.col("ids")
    if eos_id is not None:
        closed = F.when(F.size("ids") > 0, F.array_append("ids", F.lit(eos_id))).otherwise(closed)
    return encoded.withColumn("ids", closed).withColumn("len", F.size("ids"))


def piece_bytes(model: Subwords) -> list[bytes]:
    """The bytes that every id stands for; specials stand for none."""
    return [b""] * BYTE_BASE + [bytes([b]) for b in range(256)] + [p.encode() for p in model.learned_pieces()]


def decode_ids(ids: Column, bytes_by_id: list[bytes]) -> Column:
    """Text of ids through the bytes of their pieces; runs of byte pieces join into characters, unknown ids are empty."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # The last entry is that of all ids outside the table.
        blob = np.frombuffer(b"".join(bytes_by_id), np.uint8)
        lengths = np.array([*map(len, bytes_by_id), 0], np.int64)
        firsts = np.cumsum(lengths) - lengths
        for batch in batches:
            sizes = batch.value_lengths().fill_null(0).to_numpy()
            flat = batch.flatten().fill_null(-1).to_numpy()
            flat = np.where((flat < 0) | (flat >= len(bytes_by_id)), len(bytes_by_id), flat)
            widths = lengths[flat]
            data = blob[spread(firsts[flat], widths)]
            ends = np.append(0, np.cumsum(widths))[np.append(0, np.cumsum(sizes))]
            buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
            yield pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers).cast(pa.binary())

    return F.make_valid_utf8(decode(ids).cast("string"))


def decode_chars(ids: Column, vocab: dict[str, int]) -> Column:
    """Text of character ids; ids outside the vocabulary are empty."""
    by_id = [b""] * (max(vocab.values(), default=-1) + 1)
    for character, token_id in vocab.items():
        by_id[token_id] = character.encode()
    return decode_ids(ids, by_id)


def decode_subwords(ids: Column, model: Subwords) -> Column:
    """Text of subword ids: space marks become spaces, the one before the first word goes."""
    spaced = F.replace(decode_ids(ids, piece_bytes(model)), F.lit(T.SPACE_MARK), F.lit(" "))
    return F.regexp_replace(spaced, "^ ", "")


def pieces_of(ids: Column, model: Subwords) -> Column:
    """The pieces of subword ids as strings."""
    table = ["<pad>", "<unk>", "<s>", "</s>"] + [f"<0x{b:02X}>" for b in range(256)] + model.learned_pieces()
    hexed = constant_array([p.encode().hex() for p in table], "string")
    return F.transform(ids, lambda i: F.unhex(F.get(hexed, i)).cast("string"))


def round_trip(docs: DataFrame, decoded: Column, expected: Column, by: str) -> DataFrame:
    """Documents per group, and how many of them decode to what they were."""
    return docs.groupBy(by).agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(decoded == expected).alias("ok")
    )
