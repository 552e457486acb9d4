"""Operator 13: fill-in-the-middle by a piecewise-linear learned rank index.

A text's cuts are given in code points, its bytes are UTF-8. The index of a text learns the byte offset of every code point
boundary: segments of a line each, fitted greedily so that no boundary is further than ``ERROR`` bytes from its line, and one
signed byte for each boundary, the rest between line and truth. A look-up finds the segment of a rank, predicts the offset and
adds the stored rest, which makes it exact. Prefix, middle and suffix are then slices of the bytes.

Rows are worked on where they lie: nothing is shuffled, sorted or collected, so hot keys and groups of copies do not matter. A
task holds the index of one text at a time.

Defined cases: a null text counts as the empty one, and an empty text is plain; a text that holds a sentinel is plain; a null id
hashes as ``1:``; repeated rows give equal rows; very long texts are cut whole; an empty table gives an empty result;
columns whose names clash with the result's are replaced in ``transform`` and do not matter elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlens.llm.common import whole

#: Sentinels and shares of the forms, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20
#: Bytes that a boundary may lie beside its segment's line; the rest fits a signed byte.
ERROR = 127
#: Boundaries that a segment is first tried on.
REACH = 1 << 12
#: Bytes whose boundaries are learnt at once.
CHUNK = 1 << 20


@dataclass(frozen=True)
class RankIndex:
    """Byte offsets of the code point boundaries 0..n of a text."""

    first: np.ndarray  # rank at which each segment begins
    base: np.ndarray  # its byte offset
    slope: np.ndarray
    rest: np.ndarray  # of every boundary, signed bytes

    @property
    def n(self) -> int:
        return len(self.rest) - 1

    def predict(self, rank: np.ndarray) -> np.ndarray:
        """Offset on the line of the segment that holds each rank."""
        at = np.searchsorted(self.first, rank, side="right") - 1
        return self.base[at] + np.rint(self.slope[at] * (rank - self.first[at])).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """Exact byte offset of each rank."""
        return self.predict(rank) + self.rest[rank]


def boundaries(octets: bytes) -> np.ndarray:
    """Byte offsets at which code points begin."""
    return np.flatnonzero((np.frombuffer(octets, np.uint8) & 0xC0) != 0x80)


def _segments(offsets: np.ndarray, error: int) -> list[tuple[int, int, float]]:
    """(rank, offset, slope) of each segment, greedily: from its first boundary it goes on while one slope is within
    ``error`` of all of them."""
    found = []
    at, last, reach = 0, len(offsets) - 1, REACH
    while at <= last:
        begin, low, high, end = int(offsets[at]), 0.0, float("inf"), at
        while end < last:
            stop = min(last, end + reach)
            run = np.arange(end + 1 - at, stop + 1 - at)
            rise = offsets[end + 1:stop + 1] - begin
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            fits = lows <= highs
            held = len(fits) if fits[-1] else int(np.argmin(fits))
            if held:
                low, high, end = float(lows[held - 1]), float(highs[held - 1]), end + held
            if held < len(fits):
                reach = max(REACH // 16, min(reach, 2 * held))
                break
            reach *= 2
        found.append((at, begin, (low + high) / 2 if end > at else 0.0))
        at = end + 1
    return found


def learn(octets: bytes, error: int = ERROR, chunk: int = CHUNK) -> RankIndex:
    """The index of all boundaries of a text, chunk by chunk, so that beside the text only its rests are held whole."""
    if not 1 <= error <= 127:
        raise ValueError("rests are signed bytes")
    lines, rests, rank = [], [], 0
    for begin in range(0, len(octets) + 1, chunk):
        offsets = begin + boundaries(octets[begin:begin + chunk])
        if begin + chunk > len(octets):
            offsets = np.append(offsets, len(octets))  # the end is a boundary too
        if not len(offsets):
            continue
        own = _segments(offsets, error)
        first, base, slope = (np.array(c) for c in zip(*own))
        part = RankIndex(first, base, slope, np.empty(0, np.int8))
        rests.append((offsets - part.predict(np.arange(len(offsets)))).astype(np.int8))
        lines.append((first + rank, base, slope))
        rank += len(offsets)
    return RankIndex(*(np.concatenate(c) for c in zip(*lines)), np.concatenate(rests))


def draws(doc_id: str | Column = "doc_id", seed: str = "1") -> list[Column]:
    """h1 to h4 of each id: the first four groups of eight hex digits of its SHA-256."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _arranged(octets: bytes, form: str, one: int, two: int) -> tuple[bytes, int]:
    """The output of a text cut at two ranks, and the segments of its index."""
    index = learn(octets)
    a, b = index.offset(np.array([one, two])).tolist()
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    head, middle, tail = octets[:a], octets[a:b], octets[b:]
    return (b"".join((p, head, s, tail, m, middle)) if form == "psm" else b"".join((s, tail, p, head, m, middle))), len(index.first)


def transform(docs: DataFrame, text: str = "text", id_column: str = "doc_id", seed: str = "1",
              cut_share: int = CUT_SHARE, suffix_first_share: int = SUFFIX_FIRST_SHARE) -> DataFrame:
    """``docs`` with n, form (plain, psm, spm), prefix_chars, middle_chars, output and segments (of the index; null if plain)."""
    kept = [c for c in docs.columns if c.lower() not in ("n", "form", "prefix_chars", "middle_chars", "output", "segments")]
    body = whole(text)
    h1, h2, h3, h4 = draws(id_column, seed)
    n = F.char_length(body).cast("long")
    plain = (n == 0) | (h3 % 100 >= cut_share)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | body.contains(sentinel)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first_share, "spm").otherwise("psm")
    one, two = F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))

    @F.pandas_udf("struct<output: string, segments: int>")
    def arrange(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, forms, ones, twos in batches:
            out = [(t, None) if f == "plain" else _arranged(t.encode("utf-8"), f, a, b)
                   for t, f, a, b in zip(texts, forms, ones.tolist(), twos.tolist())]
            yield pd.DataFrame({"output": [o if isinstance(o, str) else o.decode("utf-8") for o, _ in out],
                                "segments": pd.array([s for _, s in out], "Int32")})

    cut = F.struct(n.alias("n"), form.alias("form"), one.alias("one"), two.alias("two"))
    rows = docs.select(*kept, body.alias("_fim_text"), cut.alias("_fim_cut"))
    done = rows.withColumn("_fim_out", arrange("_fim_text", "_fim_cut.form", "_fim_cut.one", "_fim_cut.two"))
    is_cut = F.col("_fim_cut.form") != "plain"
    return done.select(
        *kept, F.col("_fim_cut.n").alias("n"), F.col("_fim_cut.form").alias("form"),
        F.when(is_cut, F.col("_fim_cut.one")).alias("prefix_chars"),
        F.when(is_cut, F.col("_fim_cut.two") - F.col("_fim_cut.one")).alias("middle_chars"),
        F.col("_fim_out.output").alias("output"), F.col("_fim_out.segments").alias("segments"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text, from output and form alone. A cut text holds no sentinel, so the first one of a kind is the true one."""
    def split(second: str) -> tuple[Column, Column, Column]:
        body = F.substr(F.col(output), F.lit(len(PREFIX) + 1))
        one = F.substring_index(body, second, 1)
        after = F.substr(body, F.char_length(one) + len(second) + 1)
        two = F.substring_index(after, MIDDLE, 1)
        return one, two, F.substr(after, F.char_length(two) + len(MIDDLE) + 1)

    p, s, m = split(SUFFIX)
    s2, p2, m2 = split(PREFIX)
    return F.when(F.col(form) == "psm", F.concat(p, m, s)).when(F.col(form) == "spm", F.concat(p2, m2, s2)).otherwise(F.col(output))


def document_forms(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    cut = transform(docs.select("doc_id", "text"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"))


def sql() -> str:
    """DuckDB SQL for ``document_forms``."""
    draw = ", ".join(f"CAST(('0x' || substr(d, {8 * k + 1}, 8)) AS BIGINT) AS h{k + 1}" for k in range(4))
    has = " OR ".join(f"contains(t, '{s}')" for s in (PREFIX, SUFFIX, MIDDLE))
    return f"""
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
    cut AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {draw} FROM drawn),
    formed AS (
        SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN n = 0 OR {has} OR h3 % 100 >= {CUT_SHARE} THEN 'plain'
                    WHEN h4 % 100 < {SUFFIX_FIRST_SHARE} THEN 'spm' ELSE 'psm' END AS form FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t
               WHEN 'psm' THEN '{PREFIX}' || substr(t, 1, a) || '{SUFFIX}' || substr(t, b + 1) || '{MIDDLE}' || substr(t, a + 1, b - a)
               ELSE '{SUFFIX}' || substr(t, b + 1) || '{PREFIX}' || substr(t, 1, a) || '{MIDDLE}' || substr(t, a + 1, b - a)
               END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM formed"""
