"""Personal data by bootstrapped contextual extraction.

Four kinds are found by form (email, ip, card, phone). These seed the search for identifiers whose form nobody wrote down:
the two words before a find (runs of letters and digits, digits levelled, ^ for the start of the text) are a lexical
pattern, and the pattern-instance graph says which patterns stand before which strings. Spark scores it in rounds until
neither the patterns nor their confidences change; both only ever rise, so that they settle. A pattern's confidence is the share of what its distinct instances
are trusted with; an instance that is no seed is trusted as 1 - product(1 - confidence) of its good patterns. Patterns
that end above CONFIDENCE, with SUPPORT trusted instances at least, extract every candidate (a string with four digits or
more) that they stand before: kind context.

Instances count once per pattern however often they occur, so copies of a document lend no weight. Pattern and instance
counts are summed before they are shuffled; candidates meet good patterns in a join that Spark can split by size.

Defined results: null or empty text: no finds; repeated rows are judged each; an empty table gives no rows; other columns
stay with ``redact`` (a clashing name is the input's) and are left out by ``find``; doc_id may be null.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import ready, staged, text_of

KINDS = ("email", "ip", "card", "phone", "context")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")  # tried at the first digit of a number only
NUMBER = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_./+-]*+")
PATTERN_WORDS, DIGITS = 2, 4
MOST_ROUNDS, SUPPORT, CONFIDENCE, PASSING, SMOOTHING = 100, 5, 0.8, 0.5, 1.0
ASCII_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost matches of local+ "@" domain, but linear: what stands before an @ is read backwards from it."""
    at, done, last = text.find("@"), 0, -1
    while at >= 0:
        begin = max(done, last + 1)
        before = text[begin:at]
        size = len(before) - len(before.rstrip(LOCAL))
        if size and (m := DOMAIN.match(text, at)):
            yield at - size, m.end()
            done = m.end()
        last, at = at, text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers at a time of each dotted run."""
    for run in DOTTED.finditer(text):
        parts = list(NUMBER.finditer(text, run.start(), run.end()))
        for k in range(0, len(parts) - 3, 4):
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in parts[k : k + 4]):
                yield parts[k].start(), parts[k + 3].end()


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind then start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, a, b) for a, b in ips(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def pattern_before(text: str, start: int) -> str:
    """The last words before a place, lower-cased, digits levelled; ^ where the text begins. A word or gap is walked over for
    the few finds behind it only, so a text's patterns take linear time."""
    words, at = [], start
    while len(words) < PATTERN_WORDS:
        while at and not text[at - 1].isalnum():
            at -= 1
        end = at
        while at and text[at - 1].isalnum():
            at -= 1
        words.append(text[at:end] or "^")
    return ASCII_DIGITS.sub("0", " ".join(reversed(words)).lower())


FOUND = "rid long, doc_id long, spans array<struct<kind:int,start:long,end:long>>, seen array<struct<pattern:string,instance:string,seed:boolean,start:long,end:long>>"


def scan(docs: DataFrame, extra: list[str]) -> DataFrame:
    """rid (a row's own number), doc_id, the finds by form, and every pattern and instance seen."""
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    seen_type = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("seed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            found, seen = [], []
            for t in b.column("_text").to_pylist():
                spans = spans_of(t)
                here = [{"pattern": p, "instance": t[x:y].lower(), "seed": True, "start": x, "end": y} for _, x, y in spans for p in (pattern_before(t, x),)]
                taken = sorted((x, y) for _, x, y in spans)
                k = 0
                for m in TOKEN.finditer(t):
                    x, y = m.span()
                    while k < len(taken) and taken[k][1] <= x:
                        k += 1
                    if (k == len(taken) or taken[k][0] >= y) and len(ASCII_DIGITS.findall(m[0])) >= DIGITS:
                        here.append({"pattern": pattern_before(t, x), "instance": m[0].lower(), "seed": False, "start": x, "end": y})
                found.append([{"kind": c, "start": x, "end": y} for c, x, y in spans])
                seen.append(here)
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(range(rid, rid + n), pa.int64()), b.column("_doc"), pa.array(found, span), pa.array(seen, seen_type), *(b.column(f"_x{i}") for i in range(len(extra)))], names=["rid", "doc_id", "spans", "seen", *(f"_x{i}" for i in range(len(extra)))])
            rid += n

    ready(docs.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    chosen = docs.select(F.col("doc_id").cast("long").alias("_doc"), text_of().alias("_text"), *[F.col(f"`{c}`").alias(f"_x{i}") for i, c in enumerate(extra)])
    return chosen.mapInArrow(run, FOUND + "".join(f", _x{i} {kinds[c]}" for i, c in enumerate(extra)))


def good_patterns(found: DataFrame) -> DataFrame:
    """Patterns that the scored graph trusts, with their confidence."""
    edges = found.select(F.explode("seen").alias("s")).groupBy("s.pattern", "s.instance").agg(F.max("s.seed").alias("seed"))
    edges = staged(edges.withColumn("trust", F.col("seed").cast("double")), "graph")
    before = None
    for _ in range(MOST_ROUNDS):
        scored = edges.groupBy("pattern").agg(F.sum("trust").alias("mass"), F.count("*").alias("n"), F.count_if(F.col("trust") >= CONFIDENCE).alias("support"))
        confident = scored.withColumn("confidence", F.col("mass") / (F.col("n") + SMOOTHING))
        good = staged(confident.filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= PASSING)).select("pattern", "confidence"), "patterns")
        now = good.agg(F.count("*"), F.count_if(F.col("confidence") >= CONFIDENCE), F.sum(F.round(F.col("confidence") * 1000).cast("long"))).first()
        if now == before:
            return good.filter(F.col("confidence") >= CONFIDENCE)
        before = now
        heard = edges.join(good, "pattern", "left").groupBy("instance").agg(F.max("seed").alias("own"), F.sum(F.log1p(-F.coalesce("confidence", F.lit(0.0)))).alias("doubt"))
        trust = heard.select("instance", F.when(F.col("own"), F.lit(1.0)).otherwise(1 - F.exp("doubt")).alias("trust"))
        edges = staged(edges.drop("trust").join(trust, "instance").select("pattern", "instance", "seed", "trust"), "graph")
    raise RuntimeError(f"patterns did not settle in {MOST_ROUNDS} rounds")


def extracted(docs: DataFrame, extra: list[str]) -> DataFrame:
    """FOUND with more: the spans that good patterns extract (null: none)."""
    found = staged(scan(docs, extra), "pii")
    new = found.select("rid", F.explode("seen").alias("s")).filter("NOT s.seed").select("rid", "s.pattern", "s.start", "s.end")
    new = new.join(good_patterns(found), "pattern").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(F.lit(4).alias("kind"), "start", "end"))).alias("more"))
    return found.drop("seen").join(new, "rid", "left")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the spans found by form, all spans."""
    both = extracted(docs, [])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    name = F.array(*[F.lit(k) for k in KINDS])
    line = lambda a: F.array_join(F.transform(F.sort_array(a), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return both.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])], F.sha2(line(F.col("spans")), 256).alias("base_sha256"), line(F.concat("spans", F.coalesce("more", none))).alias("spans"), F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_context"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every find in text replaced by its kind in angle brackets (null text stays null)."""
    extra = docs.columns
    both = extracted(docs, extra)
    at = extra.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, spans, more in zip(b.column(f"_x{at}").to_pylist(), b.column("spans").to_pylist(), b.column("more").to_pylist(), strict=True):
                out, done = [], 0
                for s in sorted(spans + (more or []), key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= done:
                        out += [t[done : s["start"]], f"<{KINDS[s['kind']]}>"]
                    done = max(done, s["end"])
                texts.append("".join([*out, t[done:]]) if out else t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else b.column(f"_x{i}") for i in range(len(extra))], names=extra)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return both.select("spans", "more", *[f"_x{i}" for i in range(len(extra))]).mapInArrow(run, schema)
