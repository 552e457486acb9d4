"""Operator 10: token ids in a binary format, compressed by Re-Pair.

Documents are encoded where they are read, dealt into shards by ranges of their ids and written in ascending id order.
In a shard frequent pairs of neighbouring ids are replaced by nonterminals, again and again. A segment of a shard stores
its rules, the expansion length of each rule and the remaining symbols. From the lengths the place of any token is found
without expanding what lies before it (``read_span``).

File format, one Parquet row per segment: shard, segment, n_tokens, doc_ids (null ids allowed), doc_tokens, base (first
nonterminal), width (bytes of a symbol), rules (pairs of symbols), lengths (tokens of each rule), symbols; the last three as little-endian unsigned
32-bit integers, symbols as 16-bit ones where all fit. Within a segment rules refer to earlier rules only.

Defined cases: null and empty texts are the end id alone; null ids come first; equal ids are ordered by their tokens;
an empty table writes no segment; a text longer than a segment is a segment of its own. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridlens.llm.common import read, whole
from gridlens.session import scratch_path

END_ID = 2
#: Documents in a shard, and tokens after which a segment of a shard is closed.
SHARD_DOCUMENTS = 4096
SEGMENT_TOKENS = 1 << 20
#: Pairs replaced in one round, and how often a pair must occur.
ROUND_PAIRS, LEAST = 4096, 8
#: Bits of the hash that tells which pairs are counted one by one.
PLACE_BITS = 20
#: Different words and pieces (on average, of each) whose ids a worker remembers before it starts afresh.
REMEMBERED = 300_000

#: What the tokenizer's pattern takes for white space; str.split() also splits at the four separators 1C to 1F.
_SPACE = re.compile(r"[\x09-\x0D\x20\x85\xA0  -     　]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")

#: Texts of white space, printable ASCII and the letters of Latin-1: normalized but for case, each character lower-cased alone.
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")

#: The tokenizer's pattern for such texts in lower case. Its contractions begin with no letter or digit: these are tried first.
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+")

#: Array codes of unsigned integers by width.
_KIND = {2: "H", 4: "I"}

ENCODED = "id long, shard int, ids binary"
SEGMENT = ("shard int, segment int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, base long, width int, "
           "rules binary, lengths binary, symbols binary")
DECODED = "shard int, segment int, place int, id long, offset long, n_tokens long, crc long"


def _words(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


class _Pieces(dict):
    """Ids of a pre-tokenized piece by the library's model. Bytes of printable ASCII stand for themselves."""

    def __init__(self, tokenizer, kind: str) -> None:
        super().__init__()
        self.model, self.kind = tokenizer.model, kind

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = array(self.kind, [t.id for t in self.model.tokenize(piece)]).tobytes()
        return ids


class _PlainPieces(_Pieces):
    """Ids of a piece of a plain text, whose letters stand for their bytes."""

    def __init__(self, tokenizer, kind: str) -> None:
        super().__init__(tokenizer, kind)
        cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.as_bytes = {c: cut(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}

    def __missing__(self, piece: str) -> bytes:
        coded = piece if piece.isascii() else piece.translate(self.as_bytes)
        self[piece] = ids = array(self.kind, [t.id for t in self.model.tokenize(coded)]).tobytes()
        return ids


class _Words(dict):
    """Ids of a word without white space: the library's steps, each different word and piece once."""

    def __init__(self, tokenizer, kind: str) -> None:
        super().__init__()
        self.tokenizer, self.pieces, self.kind = tokenizer, _Pieces(tokenizer, kind), kind
        self.plain = _PlainPieces(tokenizer, kind)
        self.normal, self.cut = tokenizer.normalizer, tokenizer.pre_tokenizer

    def text(self, text: str) -> bytes:
        """Ids of a whole text."""
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.plain.__getitem__, _PIECE.findall(text.lower())))
        return b"".join(map(self.__getitem__, _words(text)))

    def forget(self, most: int) -> None:
        """Start afresh if more than ``most`` words and pieces are remembered."""
        if len(self) + len(self.pieces) + len(self.plain) > most:
            self.clear()
            self.pieces.clear()
            self.plain.clear()

    def __missing__(self, word: str) -> bytes:
        if "<|" in word:  # may hold a special token
            ids = array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        elif _PLAIN.fullmatch(word):
            ids = b"".join(map(self.plain.__getitem__, _PIECE.findall(word.lower())))
        else:
            ids = b"".join(self.pieces[p] for p, _ in self.cut.pre_tokenize_str(self.normal.normalize_str(word)))
        self[word] = ids
        return ids


def encode(docs: DataFrame, tokenizer_file: str, text: str = "text", id_column: str = "doc_id",
           end_id: int = END_ID, shard_documents: int = SHARD_DOCUMENTS, id_bytes: int = 4) -> DataFrame:
    """id, shard (by ranges of ids), ids (little-endian, ``id_bytes`` wide, the end id last).

    The tokenizer merges inside the pieces of its pattern only, so each different piece goes through the library once per
    worker; whole texts are put together from them. Texts of ASCII and Latin-1 letters are cut into pieces by the
    tokenizer's own pattern; others into words at white space, and words of other characters by its normalizer and pre-tokenizer.
    """
    rows = docs.filter(F.col(id_column).isNotNull()).agg(F.count("*")).first()[0]
    shards = max(1, -(-rows // shard_documents))
    cuts = [k / shards for k in range(1, shards)]
    edges = docs.agg(F.percentile_approx(F.col(id_column), cuts, 100 * shards)).first()[0] if cuts else []
    edges = np.unique(np.array(edges or [], np.int64))

    # Each Python worker holds its own copy of a broadcast list for all its tasks, and so the words it has met.
    kept = docs.sparkSession.sparkContext.broadcast([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        if not kept.value:
            kept.value.append(_Words(Tokenizer.from_file(tokenizer_file), _KIND[id_bytes]))
        coded = kept.value[0]
        end = array(_KIND[id_bytes], [end_id]).tobytes()
        for batch in batches:
            out = []
            for text in batch.column(1):
                out.append(coded.text(text.as_py()) + end)
                coded.forget(2 * REMEMBERED)
            ids = batch.column(0)
            shard = np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left").astype(np.int32)
            shard[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays([ids, pa.array(shard), pa.array(out, pa.binary())], ["id", "shard", "ids"])

    return docs.select(F.col(id_column).cast("long").alias("id"), whole(text).alias("text")).mapInArrow(run, ENCODED)


def _count(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs, rising; which of them each pair is; how often each occurs."""
    pairs = (left.astype(np.uint64) << np.uint64(32)) | right
    bits = int(max(left.max(), right.max())).bit_length() if len(left) else 0
    place_bits = len(left).bit_length()
    if not len(left) or 2 * bits + place_bits > 64:
        return np.unique(pairs, return_inverse=True, return_counts=True)
    # Pair and place in one number: sorting it is several times faster than sorting places by pairs.
    order = ((left.astype(np.uint64) << np.uint64(bits)) | right) << np.uint64(place_bits)
    order |= np.arange(len(left), dtype=np.uint64)
    order.sort()
    place = (order & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    order >>= np.uint64(place_bits)
    first = np.concatenate(([True], order[1:] != order[:-1]))
    index = np.empty(len(left), np.int64)
    index[place] = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    return pairs[place[begin]], index, np.diff(begin, append=len(left))


def compress(ids: np.ndarray, base: int, round_pairs: int = ROUND_PAIRS,
             least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols): rule k stands for the pair rules[k] and is written as base + k. Goes on until no pair of
    neighbouring symbols occurs ``least`` times (of the overlapping places of a run every second one counts)."""
    symbols, rules = ids.astype(np.uint32), np.empty((0, 2), np.uint32)
    places, at = 1 << PLACE_BITS, np.arange(len(symbols) - 1)
    while len(symbols) >= 2 * least:
        left, right = symbols[:-1], symbols[1:]
        # Places of a hash are counted first; the pairs of those that hold enough are counted one by one.
        place = ((left[at] * np.uint32(0x9E3779B1)) ^ (right[at] * np.uint32(0x85EBCA77))) >> np.uint32(32 - PLACE_BITS)
        at = at[(np.bincount(place, minlength=places) >= least)[place]]
        # A run of one symbol holds its pair at every second place only.
        alone = np.ones(len(at), bool)
        run = left[at] == right[at]
        fresh = np.concatenate(([True], (np.diff(at) != 1) | (left[at[1:]] != left[at[:-1]]) | ~run[:-1])) if len(at) else run
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        alone[run] = (np.arange(len(at)) - begin)[run] % 2 == 0
        frequent = np.zeros(len(symbols), bool)
        frequent[at[~alone]] = True
        at = at[alone]
        pairs, index, often = _count(left[at], right[at])
        frequent[at[often[index] >= least]] = True
        chosen = np.flatnonzero(often >= least)
        if not len(chosen):
            break
        if len(chosen) > round_pairs:
            chosen = chosen[np.argpartition(often[chosen], -round_pairs)[-round_pairs:]]
        number = np.full(len(pairs), -1, np.int64)
        number[chosen] = np.arange(len(chosen))
        keep = number[index] >= 0
        at, rule = at[keep], number[index[keep]]
        # Of overlapping places every second one, counted from the left end of the run.
        starts = np.concatenate(([True], np.diff(at) != 1))
        first = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - first) % 2 == 0
        at, rule = at[taken], rule[taken]
        applied = np.bincount(rule, minlength=len(chosen)) > 0
        used, rule = np.flatnonzero(applied), (np.cumsum(applied) - 1)[rule]
        symbols[at] = (base + len(rules) + rule).astype(np.uint32)
        left_over = np.ones(len(symbols), bool)
        left_over[at + 1] = False
        symbols = symbols[left_over]
        # Later rounds look at pairs that were frequent or hold a new symbol: others never occur more often than now.
        recent = symbols >= base + len(rules)
        frequent = frequent[left_over]
        at = np.flatnonzero(frequent[:-1] | recent[:-1] | recent[1:])
        new = pairs[chosen[used]]
        rules = np.concatenate((rules, np.stack((new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)), axis=1).astype(np.uint32)))
    return rules, symbols


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Tokens each rule expands to."""
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((1 if a < base else lengths[a - base]) + (1 if b < base else lengths[b - base]))
    return np.array(lengths, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    flat = np.empty(int(lengths.sum()), np.int32)
    offsets = np.concatenate(([0], np.cumsum(lengths)))[:-1] if len(lengths) else np.empty(0, np.int64)
    for k, ((a, b), at) in enumerate(zip(rules.tolist(), offsets.tolist())):
        for part in (a, b):
            if part < base:
                flat[at] = part
                at += 1
            else:
                n, other = int(lengths[part - base]), int(offsets[part - base])
                flat[at:at + n] = flat[other:other + n]
                at += n
    is_rule = symbols >= base
    if not is_rule.any():
        return symbols
    index = np.where(is_rule, symbols - base, 0)
    size = np.where(is_rule, lengths[index], 1)
    out = np.repeat(symbols, size)
    at = np.flatnonzero(np.repeat(is_rule, size))
    # Where the token of each place of a rule lies in the rules' expansions.
    shift = offsets[index] - (np.cumsum(size) - size)
    out[at] = flat[at + np.repeat(shift[is_rule], size[is_rule])]
    return out


def write(encoded: DataFrame, path: str, base: int, id_bytes: int = 4) -> None:
    """Write the segments of ``encode`` in ascending order of shard and id. ``base``: the tokenizer's vocabulary size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("base", pa.int64()),
                            ("width", pa.int32()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())])
        shard, segment, ids, parts, tokens = None, 0, [], [], 0

        def segment_row() -> pa.RecordBatch:
            rules, symbols = compress(np.frombuffer(b"".join(parts), f"<u{id_bytes}"), base)
            width = 2 if len(symbols) == 0 or symbols.max() < 1 << 16 else 4
            row = [shard, segment, tokens, ids, [len(p) // id_bytes for p in parts], base, width, rules.astype("<u4").tobytes(),
                   rule_lengths(rules, base).astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for own, at, coded in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if parts and (at != shard or tokens + len(coded) // id_bytes > SEGMENT_TOKENS):
                    yield segment_row()
                    segment = segment + 1 if at == shard else 0
                    ids, parts, tokens = [], [], 0
                shard = at
                ids.append(own)
                parts.append(coded)
                tokens += len(coded) // id_bytes
        if parts:
            yield segment_row()

    dealt = encoded.repartition("shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "ids")
    dealt.mapInArrow(run, SEGMENT).write.parquet(path)


def _segment(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
    symbols = np.frombuffer(row["symbols"], f"<u{row['width']}").astype(np.int32)
    return symbols, rules, lengths, row["base"]


def read_span(row: dict, start: int, stop: int) -> np.ndarray:
    """Tokens ``start`` to ``stop`` of a stored segment; only the symbols that cover them are expanded."""
    symbols, rules, lengths, base = _segment(row)
    size = np.ones(len(symbols), np.int64)
    size[symbols >= base] = lengths[symbols[symbols >= base] - base]
    ends = np.cumsum(size)
    first, last = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left")
    before = int(ends[first] - size[first]) if first < len(ends) else start
    return expand(symbols[first:last + 1], rules, lengths, base)[start - before:stop - before]


def decode(spark: SparkSession, path: str) -> DataFrame:
    """shard, segment, place, id, offset (in the segment), n_tokens, crc of every stored document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = expand(*_segment(row)).astype("<u4")
                ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
                starts = np.concatenate(([0], ends[:-1]))
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()),
                     pa.array(range(n), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts),
                     pa.array(row["doc_tokens"], pa.int64()), pa.array(crc, pa.int64())],
                    ["shard", "segment", "place", "id", "offset", "n_tokens", "crc"])

    return spark.read.schema(SEGMENT).parquet(path).mapInArrow(run, DECODED)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, segment, before: tokens before each segment. One row per shard meets in the window over all shards."""
    segments = spark.read.schema(SEGMENT).parquet(path).select("shard", "segment", "n_tokens")

    def earlier(window):
        return F.coalesce(F.sum("n_tokens").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    shards = shards.select("shard", earlier(Window.orderBy("shard")).alias("base_start"))
    inside = segments.select("shard", "segment", earlier(Window.partitionBy("shard").orderBy("segment")).alias("inside"))
    return inside.join(shards, "shard").select("shard", "segment", (F.col("inside") + F.col("base_start")).alias("before"))


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The contract's rows, from the files."""
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(spark, "token-ids")
    size = Tokenizer.from_file(file).get_vocab_size()
    width = 2 if size <= 1 << 16 else 4
    write(encode(read(spark, folder, "documents"), file, id_bytes=width), path, size, width)
    return decode(spark, path).join(segment_starts(spark, path), ["shard", "segment"]).select(
        F.col("id").alias("doc_id"), (F.col("before") + F.col("offset")).alias("start"), "n_tokens",
        F.col("crc").alias("ids_crc32"))
