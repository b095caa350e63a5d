"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` measures every document once and stores one bit for each rule that it fails. Policies are versioned sets of
rules: a verdict is one bitwise AND of the stored bits, so a new policy needs no second look at the texts. ``ablation``
counts, by bitwise aggregation, what each rule of a policy rejects and what it alone rejects.

Defined results: a null text counts as an empty one (no words, all counts zero, it fails ``few_words``); repeated rows are
measured one by one; an empty table gives an empty ledger; other columns of the input stay, and an input column named as
one of the ledger's is replaced. Every step works within a row, so there is no shuffle and no skew between keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burrowline.llm.common import staged, text_of

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _c(name: str) -> Column:
    return F.col(name)


#: Name and failing condition, over the measurements; a rule's place is its bit, so new rules go to the end.
RULES: list[tuple[str, Column]] = []


def rules() -> list[tuple[str, Column]]:
    """The registered rules (built when first asked for: a Column needs a session)."""
    if not RULES:
        RULES.extend(
            [
                ("few_words", _c("n_words") < 50),
                ("repeated_windows", 100 * _c("n_repeat_words") > 50 * _c("n_words")),
                ("symbol_heavy", 2 * _c("n_symbols") > _c("n_words")),
                ("short_words", 2 * _c("n_words") > _c("word_chars")),
                ("long_words", _c("word_chars") > 25 * _c("n_words")),
                ("repeated_lines", (_c("n_lines") >= 4) & (2 * _c("n_dup_lines") > _c("n_lines"))),
            ]
        )
    return RULES


#: Versioned policies: the rules by which a document is rejected.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "prose-1": ("few_words", "repeated_windows", "symbol_heavy", "short_words", "long_words", "repeated_lines"),
}
BASE = "base-1"


def mask(policy: str) -> int:
    names = [n for n, _ in rules()]
    return sum(1 << names.index(n) for n in POLICIES[policy])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements. A document's 3-word windows are hashed; only where two hashes agree are they sorted with
    their places, and neighbours with one hash count as repeats if their words agree too. Input columns go under numbers
    meanwhile, so no name of theirs can clash."""
    keep = [c for c in docs.columns if c not in (*MEASURES, "fail_bits")]
    own = [f"c{i}" for i in range(len(keep))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keep, own, strict=True)], text_of(f"`{text}`").alias("text"))
    t = F.col("text")
    parts = renamed.select(
        *own,
        F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(1)).alias("words"),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
    )
    word, n = lambda i: F.get("words", i), F.size("words")
    window = lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))
    parts = parts.select(
        *own,
        "words",
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 4, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), window)).alias("hashes"),
    )
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    parts = parts.withColumn("placed", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed))
    same_word = lambda a, b, k: word(a["i"] + k) == word(b["i"] + k)
    alike = lambda a, b: (a["h"] == b["h"]) & same_word(a, b, 0) & same_word(a, b, 1) & same_word(a, b, 2)
    places = lambda x: [x["i"], x["i"] + 1, x["i"] + 2]
    m = F.size("placed") - 1
    pair = lambda a, b: F.when(alike(a, b), F.array(*places(a), *places(b)))
    pairs = F.zip_with(F.slice("placed", F.lit(1), m), F.slice("placed", F.lit(2), m), pair)
    repeats = F.size(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    covered = F.coalesce(F.when(F.col("placed").isNotNull(), repeats), F.lit(0)).cast("long")
    # a one-element inline() names the measurements once, so that later columns reuse them and don't count again
    one = F.struct(*MEASURES[:-1], covered.alias(MEASURES[-1]))
    return parts.select(*own, F.inline(F.array(one))).toDF(*keep, *MEASURES)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements and fail_bits: bit k is set if rule k fails."""
    bits = [F.when(cond, F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, cond) in enumerate(rules())]
    return measured(docs, text).withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def stored_ledger(docs: DataFrame, key: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ledger without the texts, written to the shared folder: policies and ablations read it and no text again."""
    return staged(ledger(docs.select(*key, text), text).select(*key, *MEASURES, "fail_bits"), "ledger")


def apply_policy(led: DataFrame, policy: str, column: str = "kept") -> DataFrame:
    return led.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(led: DataFrame, policies: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """policy, rule, n_docs, n_rejected (by the policy), n_failing (the rule), n_only (kept if the rule were left out)."""
    names = [n for n, _ in rules()]
    out = []
    for p in policies:
        bits = F.col("fail_bits").bitwiseAND(F.lit(mask(p)))
        for r in POLICIES[p]:
            one = 1 << names.index(r)
            counts = {"n_docs": F.count("*"), "n_rejected": F.count_if(bits != 0), "n_failing": F.count_if(bits.bitwiseAND(F.lit(one)) != 0), "n_only": F.count_if(bits == one)}
            out.append(F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), *[c.alias(n) for n, c in counts.items()]))
    return led.agg(F.array(*out).alias("rows")).select(F.inline("rows"))


def op1(docs: DataFrame) -> DataFrame:
    led = apply_policy(apply_policy(stored_ledger(docs), BASE, "base_kept"), "prose-1")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return led.select("doc_id", *counts, (~F.col("base_kept")).alias("base_failed"), "kept", "n_lines", "fail_bits")


LEDGER_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, w, w2, w3) > 1 AS rep FROM g),
c AS (SELECT r, i, rep OR coalesce(lag(rep) OVER o, false) OR coalesce(lag(rep, 2) OVER o, false) AS cov FROM h WINDOW o AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, count(*) AS n_words, count(*) FILTER (cov) AS n_repeat_words FROM c GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
k AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END)
  + (CASE WHEN 2 * n_words > word_chars THEN 8 ELSE 0 END) + (CASE WHEN word_chars > 25 * n_words THEN 16 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END) AS fail_bits FROM m)
"""
SQL = (
    LEDGER_SQL
    + """
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, CAST(n_lines AS BIGINT) AS n_lines, CAST(fail_bits AS BIGINT) AS fail_bits FROM b
"""
)
#: The ablation of all policies: the mask and bit of each rule as stated by RULES and POLICIES.
ABLATION_SQL = (
    LEDGER_SQL
    + """,
p(policy, mask, rule, bit) AS (VALUES ('base-1', 3, 'few_words', 1), ('base-1', 3, 'repeated_windows', 2), ('prose-1', 63, 'few_words', 1), ('prose-1', 63, 'repeated_windows', 2),
  ('prose-1', 63, 'symbol_heavy', 4), ('prose-1', 63, 'short_words', 8), ('prose-1', 63, 'long_words', 16), ('prose-1', 63, 'repeated_lines', 32))
SELECT policy, rule, count(*) AS n_docs, count(*) FILTER (fail_bits & mask <> 0) AS n_rejected, count(*) FILTER (fail_bits & bit <> 0) AS n_failing, count(*) FILTER (fail_bits & mask = bit) AS n_only
FROM b, p GROUP BY policy, rule
"""
)
