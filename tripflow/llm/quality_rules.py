"""Operator 8, quality rules: a ledger of rule bits. DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule; a policy is a version name and a set of rules whose failure
rejects. Policies and ablations read the bits alone, never the texts again:

* :func:`ledger` - measurements and ``fail_bits``
* :func:`apply_policy` - ``kept`` under one version
* :func:`ablations` - for every rule of a policy, how many documents it rejects, how many
  it alone rejects, and how many would be kept without it; the bits are first counted by
  pattern, so only patterns are combined.

Null texts count as texts without words; they and empty texts fail ``few_words`` and
measure 0 throughout. Texts of any length are measured whole: per-document work is linear
but for one sort of the text's own repeated windows. Repeated rows are judged each for itself.
The ledger carries along the columns of the input, so its own names and those of its helper columns (``_words``,
``_lines``) must not be among them; :func:`ledger` raises if they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import SPACE

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rules in bit order (a rule's bit never changes): name -> SQL condition under which it fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_words": "n_words > 1000000",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines",
}


@dataclass(frozen=True)
class Policy:
    """A version of the rule set: the rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit(r) for r in self.rules)


def bit(rule: str) -> int:
    return list(RULES).index(rule)


POLICIES = {p.version: p for p in (
    Policy("base", ("few_words", "repeated_words")),
    Policy("v1", ("few_words", "repeated_words", "many_words", "short_words", "long_words", "symbols")),
    Policy("v2", tuple(RULES)),
    Policy("v3", tuple(r for r in RULES if r != "many_words")),  # length alone rejects no text
)}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Number of words that stand in a window of three words found twice or more.

    Windows are compared by 96 bits of two hashes. Texts without a repeated window
    (the distinct windows are as many) end there; in others the windows are sorted with their
    places, equal neighbours marked, and the words under the marked windows counted once.
    """
    return _let(words, _repeated_words)


def _repeated_words(words: Column) -> Column:
    windows = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(0)))

    def covered(h: Column) -> Column:
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), F.hash(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("i"))))

        def marked(s: Column) -> Column:
            same = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: (a["h"] == b["h"]) & (a["g"] == b["g"]))
            # same[i]: element i equals element i + 1 (null after the last)
            return _let(same, lambda e: F.size(F.array_distinct(F.flatten(F.transform(
                F.filter(F.transform(s, lambda x, k: F.when(F.coalesce(F.get(e, k), F.lit(False)) | F.coalesce(F.get(e, k - 1), F.lit(False)), x["i"])),
                         lambda p: p.isNotNull()),
                lambda p: F.array(p, p + 1, p + 2))))))

        return _let(keyed, marked)

    return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of ``text``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    helpers = {"_words", "_lines"} & {c.lower() for c in df.columns}
    if helpers:
        raise ValueError(f"the input already has columns {sorted(helpers)}")
    return (df.withColumn("_words", F.array_remove(F.split(t, SPACE), ""))
            .withColumn("_lines", lines)
            .withColumn("n_words", F.size("_words").cast("long"))
            .withColumn("word_chars", F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"))
            .withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
            .withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", repeated_words(F.col("_words")).cast("long"))
            .drop("_words", "_lines"))


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its measurements and ``fail_bits`` (bit k set: rule k failed).

    Store the ledger before filtering by it: a filter directly above makes Spark push
    the condition down and measure the texts once for every place that names a measurement.
    """
    clash = {*MEASURES, "fail_bits"} & set(df.columns)
    if clash:
        raise ValueError(f"the input already has columns of the ledger: {sorted(clash)}")
    bits = [F.when(F.expr(rule), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(df, text).withColumn("fail_bits", total)


def failed(rules: tuple[str, ...]) -> Column:
    """Whether any of ``rules`` failed, from the bits."""
    return F.col("fail_bits").bitwiseAND(F.lit(Policy("", rules).mask).cast("long")) != 0


def apply_policy(ledgered: DataFrame, policy: Policy) -> DataFrame:
    """Add ``kept`` under ``policy``."""
    return ledgered.withColumn("kept", ~failed(policy.rules))


def sole_rule(policy: Policy) -> Column:
    """The rule of ``policy`` that alone rejects a document, from the bits; null if none or several do."""
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    out = F.lit(None).cast("string")
    for r in policy.rules:
        out = F.when(hit == F.lit(1 << bit(r)).cast("long"), F.lit(r)).otherwise(out)
    return out


def ablations(ledgered: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of ``policy``: rejects, rejects_alone, kept_without, and the policy's kept."""
    patterns = ledgered.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    out = None
    hit = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    aggs = [F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("kept")]
    for r in policy.rules:
        own = F.lit(1 << bit(r)).cast("long")
        aggs += [F.sum(F.when(hit.bitwiseAND(own) != 0, F.col("n")).otherwise(0)).alias(f"{r}_rejects"),
                 F.sum(F.when(hit == own, F.col("n")).otherwise(0)).alias(f"{r}_alone")]
    out = patterns.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"{r}_rejects").alias("rejects"), F.col(f"{r}_alone").alias("rejects_alone"),
                              (F.col("kept") + F.col(f"{r}_alone")).alias("kept_without")) for r in policy.rules])
    return (out.select(F.lit(policy.version).alias("version"), F.coalesce("kept", F.lit(0)).alias("kept"), F.explode(rows).alias("r"))
            .select("version", "r.rule", *[F.coalesce(f"r.{c}", F.lit(0)).alias(c) for c in ("rejects", "rejects_alone", "kept_without")], "kept"))
