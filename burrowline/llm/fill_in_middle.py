"""Fill-in-middle: texts cut in three at unit boundaries and put in another order, cuts found on a wavelet matrix.

The UTF-8 bytes of a slice of texts are put into classes (other, continuation, newline, blank, sentence stop), and a wavelet
matrix over the classes answers rank and select for all texts of the slice at once. Unit boundaries are counted by the ranks
of the classes that end a unit, added up where several do; a cut is a select where one class ends the unit, and a bisection
on the added ranks otherwise. Code points are bytes less the rank of continuation bytes. Texts are never decoded.

A slice has SLICE bytes of text, or one longer text. The matrix takes about three times its slice.

Defined results: null or empty text: 0 units, plain, output empty; a text with one of the marks: plain, unchanged; a last
unit may lack its end; doc_id null: drawn as if its decimal were empty; repeated rows get a row each, equal ids cut alike;
no rows give none; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import ready, text_of

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

OTHER, CONTINUATION, NEWLINE, BLANK, STOP = range(5)
BITS = 3
#: Classes whose bytes end a unit.
UNITS = {"line": (NEWLINE,), "word": (NEWLINE, BLANK), "sentence": (NEWLINE, STOP)}
SLICE = 4 << 20


def classes() -> np.ndarray:
    """The class of each byte."""
    out = np.full(256, OTHER, np.uint8)
    out[0x80:0xC0] = CONTINUATION
    out[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
    out[[ord(c) for c in ".!?"]] = STOP
    out[0x0A] = NEWLINE
    return out


class Bits:
    """A bit vector with rank and select, for arrays of queries."""

    def __init__(self, bit: np.ndarray):
        packed = np.packbits(bit, bitorder="little")
        self.n = len(bit)
        self.words = np.zeros(len(bit) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.zeros = self.n - int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first `at` bits."""
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low).astype(np.int64)

    def select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Place of the k-th (from 0) bit of that value."""
        before = self.before if bit else np.arange(len(self.before)) * 64 - self.before
        w = np.searchsorted(before, k, "right") - 1
        words = self.words[w] if bit else ~self.words[w]
        seen = np.cumsum(np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=1)
        return w * 64 + (seen <= (k - before[w])[:, None]).sum(axis=1)


class WaveletMatrix:
    """Symbols below 2 ** bits: how many of one stand before a place (rank), and where its k-th stands (select)."""

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.n, self.levels = len(symbols), []
        for k in reversed(range(bits)):
            bit = ((symbols >> k) & 1).astype(bool)
            self.levels.append((k, Bits(bit)))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(1, np.int64), at
        for k, level in self.levels:
            ones = symbol >> k & 1
            lo, hi = (level.zeros + level.rank(x) if ones else x - level.rank(x) for x in (lo, hi))
        return hi - lo

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        lo = np.zeros(1, np.int64)
        for b, level in self.levels:
            lo = level.zeros + level.rank(lo) if symbol >> b & 1 else lo - level.rank(lo)
        at = lo + k
        for b, level in reversed(self.levels):
            at = level.select(at - level.zeros, 1) if symbol >> b & 1 else level.select(at, 0)
        return at


class Cuts:
    """Units and cuts of the texts data[bounds[i]:bounds[i + 1]]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, unit: str):
        self.matrix, self.ends = WaveletMatrix(classes()[data]), UNITS[unit]
        self.start, self.stop = bounds[:-1], bounds[1:]
        self.base = self.ended(self.start)
        self.whole = self.ended(self.stop) - self.base
        last = np.isin(classes()[data[np.maximum(self.stop - 1, 0)]], self.ends) if len(data) else np.zeros(len(self.start), bool)
        self.n = self.whole + ((self.stop > self.start) & ~last)

    def ended(self, at: np.ndarray) -> np.ndarray:
        """Units that end before a place of the slice."""
        return sum(self.matrix.rank(c, at) for c in self.ends)

    def characters(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return hi - lo - (self.matrix.rank(CONTINUATION, hi) - self.matrix.rank(CONTINUATION, lo))

    def after(self, k: np.ndarray) -> np.ndarray:
        """Where each text's k-th unit ends."""
        at = np.where(k > self.whole, self.stop, self.start)
        inner = (k > 0) & (k <= self.whole)
        if len(self.ends) == 1:
            at[inner] = self.matrix.select(self.ends[0], (self.base + k - 1)[inner]) + 1
            return at
        lo, hi, wanted = self.start[inner], self.stop[inner], (self.base + k)[inner]
        while (lo < hi).any():  # the first place with so many ends before it
            mid = (lo + hi) // 2
            enough = self.ended(mid) >= wanted
            lo, hi = np.where(enough, lo, mid + 1), np.where(enough, mid, hi)
        at[inner] = lo
        return at


def slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts with SLICE bytes together, or one longer text."""
    begun, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > SLICE:
            yield begun, i
            begun, held = i, 0
        held += n
    if begun < len(lengths):
        yield begun, len(lengths)


def cutter(unit: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
            data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] else np.zeros(0, np.uint8)
            plain, spm = (np.array(b.column(c).to_pylist(), bool) for c in ("plain", "spm"))
            h1, h2 = (b.column(c).to_numpy() for c in ("h1", "h2"))
            for lo, hi in slices(np.diff(offsets)):
                part = data[offsets[lo] : offsets[hi]]
                bounds = offsets[lo : hi + 1] - offsets[lo]
                cuts = Cuts(part, bounds, unit)
                k1, k2 = h1[lo:hi] % (cuts.n + 1), h2[lo:hi] % (cuts.n + 1)
                p, m = cuts.after(np.minimum(k1, k2)), cuts.after(np.maximum(k1, k2))
                before, between = cuts.characters(bounds[:-1], p), cuts.characters(p, m)
                raw, forms, outputs = part.tobytes(), [], []
                for i, (a, x, y, z) in enumerate(zip(bounds[:-1].tolist(), p.tolist(), m.tolist(), bounds[1:].tolist(), strict=True)):
                    first, second, third = raw[a:x], raw[x:y], raw[y:z]
                    if plain[lo + i]:
                        forms.append("plain")
                        outputs.append(raw[a:z])
                    elif spm[lo + i]:
                        forms.append("spm")
                        outputs.append(b"".join((SUFFIX.encode(), third, PREFIX.encode(), first, MIDDLE.encode(), second)))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((PREFIX.encode(), first, SUFFIX.encode(), third, MIDDLE.encode(), second)))
                hidden = plain[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(cuts.n, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64(), mask=hidden), pa.array(between, pa.int64(), mask=hidden), pa.array(outputs, pa.binary())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def transform(docs: DataFrame, unit: str = "line", rate: int = 100, spm: int = 50, seed: int = 7) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars and output of every document. rate: how many of
    a hundred documents are cut; spm: how many of a hundred cut ones have the suffix first. What is drawn depends on seed and
    doc_id alone, so that a task that runs again draws the same."""
    ready(docs.sparkSession)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(hashed, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    text = text_of()
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (h[2] % 100 >= rate)
    drawn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h[0].alias("h1"), h[1].alias("h2"), plain.alias("plain"), (h[3] % 100 < spm).alias("spm"))
    out = drawn.mapInArrow(cutter(unit), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output. No part of a cut text has a mark, and no mark can begin within another, so the first place
    of each mark is where it was put."""
    rest = F.substr(output, F.lit(4))
    upto = lambda text, mark: F.substring_index(text, mark, 1)
    past = lambda text, mark: F.substr(text, F.length(upto(text, mark)) + 4)
    psm = F.concat(upto(rest, SUFFIX), past(past(rest, SUFFIX), MIDDLE), upto(past(rest, SUFFIX), MIDDLE))
    spm = F.concat(upto(past(rest, PREFIX), MIDDLE), past(past(rest, PREFIX), MIDDLE), upto(rest, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12(docs: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    out = transform(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, t, l, CASE WHEN t = '' THEN 0 WHEN t LIKE '%' || chr(10) THEN len(l) - 1 ELSE len(l) END AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS k1, greatest(h1 % (n + 1), h2 % (n + 1)) AS k2, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain FROM u),
e AS (SELECT *, CASE WHEN k1 = n THEN length(t) WHEN k1 = 0 THEN 0 ELSE length(array_to_string(l[1:k1], chr(10))) + 1 END AS p, CASE WHEN k2 = n THEN length(t) WHEN k2 = 0 THEN 0 ELSE length(array_to_string(l[1:k2], chr(10))) + 1 END AS m FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form, CASE WHEN NOT plain THEN p END AS prefix_chars, CASE WHEN NOT plain THEN m - p END AS middle_chars,
sha256(CASE WHEN plain THEN t WHEN h4 % 100 < 50 THEN '<S>' || substr(t, m + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, m - p) ELSE '<P>' || substr(t, 1, p) || '<S>' || substr(t, m + 1) || '<M>' || substr(t, p + 1, m - p) END) AS output_sha256, sha256(t) AS restored_sha256 FROM e"""
