"""Secret scanning with a randomness test battery, in DataFrame functions only.

Three kinds come from their patterns alone (assign, access, hex). A fourth, random, is found by statistics: every other
token of 20 or more encoding characters is a candidate. Its encoding (hex, base32, lower-case base36, base62, base64) is
inferred from the characters that it uses, and a battery of tests looks at its symbols:
  chi-squared uniformity over the encoding's alphabet, a runs test (upper or lower half of the alphabet), and a lag-1
  serial correlation.
Each test speaks twice. Under "independent uniform symbols" its three p-values are combined by Fisher's method: doubt, how
unlike a random token it is. Under "ordinary text" (independent letters with English frequencies, or decimal digits) the
same three statistics have their own mean and spread; their z scores are averaged with weights for how far randomness
shifts each of them (a weighted mean of z scores is no wider than one, however the tests depend on each other): evidence,
how unlike text it is. A token is found if its evidence is discovered and its doubt is not. Longer tokens give stronger
evidence, so both false-discovery rates are controlled by Benjamini-Hochberg within strata of length. P-values are counted
in bins of an eighth of a decade and a bin counts with its largest p, so the thresholds come from at most 2 x 4 x 401
counts, however many tokens there are.

Positions of matches are sums of the lengths of what a split by the pattern leaves and of the matches themselves, taken
in chunks so that a text with very many matches stays linear but for the chunks' own sums.

Defined results: null text counts as empty; repeated rows are judged each; an empty table gives no rows; other columns of
the input are left out. No text moves between tasks: one pass writes the matches, the thresholds are then applied to them.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import staged, text_of

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ("assign", "access", "hex", "random")
#: Kind, pattern, condition on a match. Classes that fill a whole run of characters take their least length in the pattern.
PATTERNS = (
    ("assign", ASSIGN, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12),
    ("access", "AKIA[A-Z0-9]{14,}", None),
    ("hex", "[0-9a-f]{16,}", None),
    ("random", "[A-Za-z0-9+/=_-]{20,}", None),
)
#: Encoding, what tokens of it look like, alphabet, and what ordinary text in it is made of.
ENCODINGS = (
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", "digits"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "capitals"),
    ("base36", "^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz", "letters"),
    ("base62", "^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "mixed"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "mixed"),
)
#: Frequencies of the letters A to Z in English, per cent.
ENGLISH = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Share of capitals in mixed text; length at which the weights of the tests are taken.
CAPITALS, TYPICAL = 0.05, 40


def text_model(alphabet: str, kind: str) -> dict[str, float]:
    """Ordinary text in an alphabet: sums of squared and cubed frequencies, the chance of the upper half, mean place (from the
    middle) and spread, and the weights of the three tests."""
    letters = [chr(ord("a") + i) for i in range(26)]
    share = {c: f / sum(ENGLISH) for c, f in zip(letters, ENGLISH, strict=True)}
    if kind == "digits":
        q = dict.fromkeys("0123456789", 0.1)
    elif kind == "mixed":
        q = {c: f * (1 - CAPITALS) for c, f in share.items()} | {c.upper(): f * CAPITALS for c, f in share.items()}
    else:
        q = {c.upper() if kind == "capitals" else c: f for c, f in share.items()}
    k, middle = len(alphabet), (len(alphabet) - 1) / 2
    at = [(alphabet.index(c) - middle, f) for c, f in q.items()]
    a = sum(d * f for d, f in at)
    m = {"q2": sum(f**2 for _, f in at), "q3": sum(f**3 for _, f in at), "u": sum(f for d, f in at if d > 0), "a": a, "s2": sum((d - a) ** 2 * f for d, f in at)}
    means, spreads = under_text(TYPICAL, m)
    n = TYPICAL
    uniform = (n + n * (n - 1) / k, (n - 1) / 2, 0.0)
    shift = [((x - y) / w**0.5) ** 2 for x, y, w in zip(means, uniform, spreads, strict=True)]
    return m | {f"w{i}": x / sum(shift) for i, x in enumerate(shift)}


def under_text(n, m) -> tuple[tuple, tuple]:
    """Mean and variance of the sum of squared counts, the changes of half and the lagged products in n symbols of text; of
    numbers or of columns."""
    q2, q3, u, a, s2 = (m[x] for x in ("q2", "q3", "u", "a", "s2"))
    change = 2 * u * (1 - u)
    return (n + n * (n - 1) * q2, (n - 1) * change, (n - 1) * a * a), (
        2 * n * (n - 1) * (q2 - q2 * q2) + 4 * n * (n - 1) * (n - 2) * (q3 - q2 * q2),
        (n - 1) * change * (1 - change) + 2 * (n - 2) * (u * (1 - u) - change * change),
        (n - 1) * (2 * a * a * s2 + s2 * s2) + 2 * (n - 2) * a * a * s2,
    )


MODELS = [text_model(alphabet, kind) for _, _, alphabet, kind in ENCODINGS]
STRATA = (32, 48, 80)
#: Spans of a kind in a text that are looked at one by one.
FEW = 32
CHUNK, BINS, LN10 = 256, 400, 2.302585092994046


def tail(z: Column) -> Column:
    """-log10 of the standard normal distribution function at z (Zelen and Severo's polynomial; z above 0 counts as 0)."""
    x = F.greatest(-z, F.lit(0.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return x * x / 2 * 0.4342944819 + 0.3990899342 - F.log10(poly)


def battery(token: Column) -> Column:
    """encoding, n, z_chi, z_runs, z_serial (under randomness), doubt and evidence: -log10 p under randomness and under text."""
    body = F.rtrim(F.translate(token, "-_", "+/"), F.lit("="))
    chosen = F.lit(len(ENCODINGS) - 1)
    for i, (_, pattern, _, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
        chosen = F.when(body.rlike(pattern), i).otherwise(chosen)
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), chosen + 1)
    made = F.struct(
        F.when(chosen == 0, F.lower(body)).otherwise(body).alias("body"), of([e[0] for e in ENCODINGS]).alias("encoding"), of([e[2] for e in ENCODINGS]).alias("alphabet"),
        of([float(len(e[2])) for e in ENCODINGS]).alias("k"), F.struct(*[of([m[x] for m in MODELS]).alias(x) for x in MODELS[0]]).alias("m"),
    )

    def counted(s: Column) -> Column:
        places = F.filter(F.transform(F.split(s["body"], ""), lambda c: F.when(c == "", -1).otherwise(F.instr(s["alphabet"], c) - 1)), lambda p: p >= 0)
        return F.struct(s["encoding"].alias("encoding"), s["k"].alias("k"), s["m"].alias("m"), places.alias("x"))

    def summed(s: Column) -> Column:
        x, k = s["x"], s["k"]
        n = F.size(x).cast("double")
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda a, v: a + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))
        upper = F.size(F.filter(x, lambda v: 2 * v >= k)).cast("double")
        steps = F.zip_with(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        changes = F.size(F.filter(steps, lambda p: (2 * p["a"] >= k) != (2 * p["b"] >= k))).cast("double")
        product = F.aggregate(steps, F.lit(0.0), lambda a, p: a + (p["a"] - (k - 1) / 2) * (p["b"] - (k - 1) / 2))
        return F.struct(s["encoding"].alias("encoding"), k.alias("k"), s["m"].alias("m"), n.alias("n"), squares.alias("squares"), upper.alias("upper"), changes.alias("changes"), product.alias("product"))

    def scored(s: Column) -> Column:
        n, k, m = s["n"], s["k"], s["m"]
        chi = (k * s["squares"] / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        mean = 1 + 2 * s["upper"] * (n - s["upper"]) / n
        runs = F.when(mean > 2, (s["changes"] + 1 - mean) / F.sqrt((mean - 1) * (mean - 2) / (n - 1))).otherwise(F.lit(99.0))
        serial = s["product"] / (n - 1) / ((k * k - 1) / 12) * F.sqrt(n - 1)
        both_sides = lambda z: F.greatest(tail(-F.abs(z)) - 0.30103, F.lit(0.0))
        y = LN10 * (tail(-chi) + both_sides(runs) + both_sides(serial))
        doubt = y / LN10 - F.log10(1 + y + y * y / 2)  # Fisher: the upper tail of chi-squared with six degrees of freedom
        means, spreads = under_text(n, m)
        signs = (1, -1, 1)  # randomness evens counts out, changes halves more often, and leaves no lagged product
        z = sum(m[f"w{i}"] * sign * (s[x] - mean) / F.sqrt(var) for i, (x, sign, mean, var) in enumerate(zip(("squares", "changes", "product"), signs, means, spreads, strict=True)))
        ok = n >= 16
        none = F.lit(None).cast("double")
        values = (("z_chi", chi), ("z_runs", runs), ("z_serial", serial), ("doubt", doubt), ("evidence", tail(z)))
        return F.struct(s["encoding"].alias("encoding"), n.cast("int").alias("n"), *[F.when(ok, v).otherwise(none).alias(name) for name, v in values])

    # one-element arrays: each step's outcome is named once and not written out again where it is used
    steps = F.array(made)
    for f in (counted, summed, scored):
        steps = F.transform(steps, f)
    return F.element_at(steps, 1)


def binned(evidence: Column) -> Column:
    return F.least(F.floor(evidence * 8), F.lit(BINS)).cast("int")


def stratum(n: Column) -> Column:
    out = F.lit(0)
    for limit in STRATA:
        out = out + F.when(n >= limit, 1).otherwise(0)
    return out


def located(gaps: Column, hits: Column) -> Column:
    """Array of (start, end, hit) from what a split by the pattern leaves and what the pattern matched."""
    at = lambda i: F.struct(F.length(F.get(gaps, i)).cast("long").alias("gap"), F.length(F.get(hits, i)).cast("long").alias("size"), F.get(hits, i).alias("hit"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / CHUNK).cast("int")), lambda c: F.transform(F.sequence(c * CHUNK, F.least((c + 1) * CHUNK, F.size(hits)) - 1), at))
    sums = lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x["gap"] + x["size"])
    begin = lambda p: F.aggregate(F.transform(p, sums), F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")

    def chunk(p: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), none.alias("out"))
        step = lambda a, x: F.struct((a["at"] + x["gap"] + x["size"]).alias("at"), F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["size"]).alias("end"), x["hit"].alias("hit")))).alias("out"))
        return F.aggregate(p, first, step, lambda a: a["out"])

    whole = F.transform(F.array(parts), lambda p: F.flatten(F.zip_with(p, F.slice(begin(p), F.lit(1), F.size(p)), chunk)))
    return F.when(F.size(hits) > 0, F.element_at(whole, 1)).otherwise(none)


def touches(spans: Column, s: Column) -> Column:
    """Whether one of a kind's spans overlaps s. They come in order and apart from each other, so of those that begin before
    s ends the last one ends last; where there are many it is found by bisection."""

    def halved(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        more = (a["lo"] < a["hi"]) & (F.get(spans, mid)["start"] < s["end"])
        return F.struct(F.when(more, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(more, a["hi"]).otherwise(F.least(mid, a["hi"])).alias("hi"))

    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(spans).cast("long"))))
    before = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halved, lambda a: a["lo"])
    last = F.when(before > 0, F.get(spans, before - 1)["end"] > s["start"]).otherwise(False)
    few = F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return F.when(F.size(spans) <= FEW, few).otherwise(F.coalesce(last, F.lit(False)))


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, an array (start, end) for each base kind, and cands (start, end, stratum, bin, ok, ...) for the fourth."""
    d = docs.select("doc_id", text_of(f"`{text}`").alias("_t"))
    cols = []
    for kind, pattern, _ in PATTERNS:
        found = F.col("_t").rlike(pattern)
        cols += [F.when(found, F.split("_t", pattern, -1)).alias(f"_g_{kind}"), F.when(found, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).alias(f"_h_{kind}")]
    d = d.select("doc_id", *cols)
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    d = d.select("doc_id", *[F.coalesce(located(F.col(f"_g_{k}"), F.col(f"_h_{k}")), none).alias(f"_l_{k}") for k in KINDS])
    passing = lambda a, ok: F.filter(a, lambda s: ok(s["hit"])) if ok else a
    bare = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["end"]))
    d = d.select("doc_id", *[bare(passing(F.col(f"_l_{k}"), ok)).alias(k) for k, _, ok in PATTERNS[:3]], F.col("_l_random").alias("_random"))
    free = F.filter("_random", lambda s: ~_any([touches(F.col(k), s) for k, _, _ in PATTERNS[:3]]))
    judged = F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), battery(s["hit"]).alias("t")))
    d = d.select("doc_id", "assign", "access", "hex", judged.alias("_judged"))
    shown = F.transform(F.filter("_judged", lambda s: s["t"]["evidence"].isNotNull()), lambda s: F.struct(
        s["start"], s["end"], stratum(s["t"]["n"]).alias("stratum"), binned(s["t"]["evidence"]).alias("bin"), binned(s["t"]["doubt"]).alias("doubt_bin"),
        *[s["t"][x].alias(x) for x in ("encoding", "z_chi", "z_runs", "z_serial", "doubt", "evidence")],
    ))
    return d.select("doc_id", "assign", "access", "hex", shown.alias("cands"))


def thresholds(found: DataFrame, rate: float, column: str = "bin") -> dict[int, int]:
    """Per stratum of length the least bin that Benjamini-Hochberg accepts at this false-discovery rate."""
    counts = found.select(F.explode("cands").alias("c")).groupBy("c.stratum", F.col(f"c.{column}").alias("bin")).agg(F.count("*").alias("n"))
    by: dict[int, dict[int, int]] = defaultdict(dict)
    for r in counts.collect():  # a row per stratum and bin: 4 x 401 at most
        by[r["stratum"]][r["bin"]] = r["n"]
    out = {}
    for s, bins in by.items():
        total, reached = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            reached += bins[b]
            if total * 10 ** (-b / 8) <= rate * reached:
                out[s] = b
    return out


def secrets(docs: DataFrame, rate: float = 0.01, text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    found = staged(matches(docs, text), "secrets")
    limits = {c: thresholds(found, rate, c) for c in ("bin", "doubt_bin")}
    named = lambda a, kind: F.transform(a, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    found_by = lambda s, c: _any([(s["stratum"] == F.lit(k)) & (s[c] >= F.lit(b)) for k, b in limits[c].items()])
    passes = lambda s: found_by(s, "bin") & ~found_by(s, "doubt_bin")
    base = F.concat(*[named(F.col(k), k) for k in KINDS[:3]])
    rows = found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], base.alias("_base"), F.filter("cands", passes).alias("_random"))
    line = lambda a: F.array_join(F.transform(F.sort_array(a), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(line(F.col("_base")), 256).alias("base_sha256"), line(F.concat("_base", named(F.col("_random"), "random"))).alias("spans"), F.size("_random").cast("long").alias("n_random"))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
