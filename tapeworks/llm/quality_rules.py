"""Quality rules of documents, judged per host with shrunken failure rates. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import SPACE, WORD, stored

# The signs that count as symbols, the words of a window.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, inside higher-order functions too."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, from the hashes of a text's words."""
    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(row: Column) -> Column:
            last = F.size(row) - 1
            again = F.filter(row, lambda x, k: ((k > 0) & (row[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
                             | ((k < last) & (row[F.least(k + 1, last)]["h"] == x["h"])))
            return F.array_sort(F.transform(again, lambda x: x["i"]))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            _let(pairs, starts), zero,
            lambda a, s: F.struct((s + WINDOW).alias("end"),
                                  (a["n"] + (s + WINDOW - F.greatest(s, a["end"]))).cast("long").alias("n")),
            lambda a: a["n"])

    def windows(row: Column) -> Column:
        last = F.size(row) - WINDOW
        return F.when(last < 1, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[row[i + k] for k in range(WINDOW)])))

    # Most texts repeat no window; only the others are sorted.
    return _let(_let(hashes, windows), lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))


def document_counts(text: Column) -> dict[str, Column]:
    """Counts of a text by name; a NULL text has none of anything."""
    whole = F.coalesce(text, F.lit(""))
    hashes = F.transform(F.regexp_extract_all(whole, F.lit(f"({WORD})")), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD))
    return {
        "n_words": F.regexp_count(whole, F.lit(WORD)).cast("long"),
        "word_chars": (F.length(whole) - F.regexp_count(whole, F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(hashes),
    }


def rule_failures(max_symbols: float = 0.1, max_repeat: float = 0.2, min_words: int = 10,
                  word_length: tuple[float, float] = (2.0, 15.0)) -> dict[str, Column]:
    """The rules, as conditions on the counts that hold where a document fails."""
    n = F.col("n_words")
    return {
        "few_words": n < min_words,
        "repeats": F.col("n_repeat_words") > max_repeat * n,
        "symbols": F.col("n_symbols") > max_symbols * n,
        "dup_lines": F.col("n_dup_lines") * 10 > n,
        "word_length": (n > 0) & ~F.coalesce(
            F.try_divide(F.col("word_chars"), n).between(*word_length), F.lit(False)),
    }


def beta_prior(rate: Column, docs: Column) -> Column:
    """Struct (a, b) of the beta distribution fitted to host rates by moments, weighted by documents.

    Without spread between hosts (one host, equal rates) the prior is as heavy as the average host.
    """
    mean = F.sum(rate * docs) / F.sum(docs)
    variance = F.sum(rate * rate * docs) / F.sum(docs) - mean * mean
    weight = F.when(variance > 1e-12, mean * (1 - mean) / variance - 1)
    weight = F.greatest(F.coalesce(weight, F.sum(docs) / F.count("*")), F.lit(1.0))
    weight = F.least(weight, F.sum(docs) / F.count("*") + 1)
    mean = F.least(F.greatest(mean, F.lit(0.0)), F.lit(1.0))
    return F.struct((mean * weight).alias("a"), ((1 - mean) * weight).alias("b"))


def host_verdicts(counted: DataFrame, host: str, rules: dict[str, Column], limit: float) -> DataFrame:
    """One row per host: documents, shrunken failure rate per rule, worst rate, verdict.

    A rate is (failures + a) / (documents + a + b) with the empirical beta prior of its rule.
    """
    rates = stored(
        counted.groupBy(F.col(host).alias("host"))
        .agg(F.count("*").alias("host_docs"),
             *[F.sum(F.when(c, 1).otherwise(0)).alias(f"fail_{r}") for r, c in rules.items()]),
        "host-rules")
    # One row of priors, as a scalar subquery.
    priors = rates.agg(F.struct(*[
        beta_prior(F.col(f"fail_{r}") / F.col("host_docs"), F.col("host_docs")).alias(r)
        for r in rules]).alias("p")).scalar()
    with_priors = rates.withColumn("p", priors)
    shrunk = with_priors.select("host", "host_docs", *[
        ((F.col(f"fail_{r}") + F.col(f"p.{r}.a"))
         / (F.col("host_docs") + F.col(f"p.{r}.a") + F.col(f"p.{r}.b"))).alias(f"rate_{r}")
        for r in rules])
    worst = F.greatest(*[F.col(f"rate_{r}") for r in rules], F.lit(0.0))
    return shrunk.select("*", worst.alias("host_rate"), (worst <= limit).alias("host_kept"))


def quality_rules(docs: DataFrame, host: str = "source", host_limit: float = 0.5,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base verdict and host verdict of every document.

    Returns doc_id, the counts, base_failed, kept, host, host_docs, host_rate. A document is kept if it
    passes the base rules and no rule's shrunken failure rate of its host is above ``host_limit``.
    Rows keep their number: NULL and empty texts have no words and fail, NULL hosts are one host, NULL
    and repeated ids stay, other columns are ignored. Texts are counted once and stored; hosts are
    aggregates with a map-side part, so a host with a third of all rows needs no large task.
    """
    n = F.col("n_words")
    counted = stored(
        docs.select(docs[doc_id].alias("doc_id"), docs[host].alias("host"),
                    *[c.alias(name) for name, c in document_counts(docs[text]).items()])
        .withColumn("base_failed", (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)),
        "document-rules")
    hosts = stored(host_verdicts(counted, "host", rule_failures(), host_limit), "host-verdicts")
    verdicts = hosts.select(F.col("host").alias("host_name"), "host_docs", "host_rate", "host_kept")
    return (counted.join(verdicts, counted["host"].eqNullSafe(verdicts["host_name"]), "left")
            .select("doc_id", *COUNTS, "base_failed",
                    (~F.col("base_failed") & F.col("host_kept")).alias("kept"),
                    "host", "host_docs", "host_rate"))
