"""Quality rules as a bitmask ledger.

Every rule is evaluated once per whole text; the ledger keeps the measurements
and one failure bit per rule.  A versioned policy is a mask of the rules that
it enforces, so verdicts, new policy versions and ablations (what would each
rule alone change?) are bitwise operations on the ledger, without the texts.

Words are runs outside ``[\\x20\\x09-\\x0D]``.  Cases: a null text measures as an
empty one (no words: it fails ``few_words``); repeated rows and null ids each
have their row; an empty table gives an empty ledger and ablations of zero;
only doc_id and text are read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepared, texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_capitals", "n_letters", "n_marks", "n_alpha_words")

#: Rule name -> condition (over the measures) under which a text fails; the
#: position is the bit.  Append only: stored ledgers keep their meaning.
RULES = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "capitals": "2 * n_capitals > n_letters",
    "marks": "10 * n_marks > 3 * n_words",
    "few_alpha_words": "10 * n_alpha_words < 7 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}
BASE = ("few_words", "repeats")
#: Policy version -> rules that it enforces.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "dup_lines"),
    "v2": tuple(RULES),
}

_SPACES = bytes([32, *range(9, 14)])
_CONTINUATION = bytes(range(0x80, 0xC0))
_ALPHA = re.compile(rb"[A-Za-z\x80-\xff]").search


def repeated_words(words: list[bytes], n: int = 3) -> int:
    """Words inside n-word windows that occur twice or more, the first included."""
    if len(words) <= n:
        return 0
    seen: dict[bytes, int] = {}
    code = ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    for k in range(1, n):  # ids of k+1-word windows, dense again after each word
        code = np.unique(code[:-1] * len(seen) + ids[k:], return_inverse=True)[1]
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(again), 1)
    np.add.at(covered, np.flatnonzero(again) + n, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    capitals = sum(map(text.count, (bytes([c]) for c in range(65, 91))))
    letters = len(text) - len(text.translate(None, bytes([*range(65, 91), *range(97, 123)])))
    return (len(words), len(text.translate(None, _SPACES + _CONTINUATION)),
            len(text) - len(text.translate(None, b"#*$%&|<>")),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            capitals, letters, text.count(b"!") + text.count(b"?"), sum(1 for w in words if _ALPHA(w)))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measures (long) and ``failed``: the bits of the rules failed."""
    prepared(docs.sparkSession)

    def run(batches):
        for pdf in batches:
            out = pd.DataFrame([measure(t) for t in pdf["text"].tolist()], columns=MEASURES, dtype="int64")
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    got = texts(docs).mapInPandas(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " + ".join(f"(case when {cond} then {BIT[name]}L else 0L end)" for name, cond in RULES.items())
    return got.withColumn("failed", F.expr(bits))


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def verdicts(found: DataFrame, policy: str = "v2") -> DataFrame:
    """``found`` (a ledger) with base_failed and kept under a policy; the base rules always hold."""
    return (found.withColumn("base_failed", F.col("failed").bitwiseAND(mask("base")) != 0)
            .withColumn("kept", F.col("failed").bitwiseAND(mask(policy) | mask("base")) == 0))


def ablations(found: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of a policy: documents that fail it, and that fail nothing else
    (they come back if the rule is dropped).  One pass over the ledger."""
    of = F.col("failed").bitwiseAND(mask(policy))
    names = POLICIES[policy]
    sums = found.agg(*[F.count(F.when(of.bitwiseAND(BIT[r]) != 0, 1)).alias(f"f_{r}") for r in names],
                     *[F.count(F.when(of == BIT[r], 1)).alias(f"o_{r}") for r in names])
    return sums.select(F.explode(F.array(*[F.struct(
        F.lit(policy).alias("policy"), F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"),
        F.col(f"o_{r}").alias("n_only")) for r in names])).alias("x")).select("x.*")


def quality(docs: DataFrame, policy: str = "v2") -> DataFrame:
    return verdicts(ledger(docs), policy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.col("failed").alias("failed_bits"))


ORACLE = """
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as ls from t),
g as (select r, i, ws[i] as a, ws[i+1] as b, ws[i+2] as c from w, unnest(generate_series(1, len(ws) - 2)) u(i)),
again as (select r, i from (select r, i, count(*) over (partition by r, a, b, c) as n from g) where n > 1),
cov as (select r, count(distinct p) as n from (select r, unnest([i, i+1, i+2]) as p from again) group by r),
m as (select w.r, doc_id, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
        len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_capitals,
        length(regexp_replace(text, '[^A-Za-z]', '', 'g')) as n_letters,
        length(regexp_replace(text, '[^!?]', '', 'g')) as n_marks,
        len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z]') or octet_length(encode(x)) > length(x))) as n_alpha_words
      from w left join cov on w.r = cov.r),
b as (select *, """ + " + ".join(f"(case when {c} then {BIT[n]} else 0 end)" for n, c in RULES.items()) + """ as failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 as base_failed,
  failed = 0 as kept, failed::bigint as failed_bits
from b
"""
