"""Rules of quality for documents and for the hosts they come from.

Rules count words, symbols, repeated lines and repeated word windows of a document. Failures of each rule are then added
up by host, each host's rate is drawn towards the rule's common rate by a beta prior fitted to all hosts, and hosts whose
rate of any rule stays high lose all their documents. Everything is columns and joins; no Python runs in the tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.files import stored

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Limits of a document: words at least, percent of its words in repeats, symbols per hundred words, repeated lines,
    and mean characters of a word. One beyond the first or second fails on its own; the others tell of its host only.

    A host is rejected if its rate of failures of any rule is over the rule's limit after shrinking.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10
    max_dup_lines: int = 2
    min_word_chars: int = 3
    max_word_chars: int = 10
    host_limits: tuple[tuple[str, float], ...] = (
        ("short", 0.75),
        ("repeats", 0.75),
        ("symbols", 0.5),
        ("lines", 0.5),
        ("word_length", 0.5),
    )

    def failures(self) -> dict[str, Column]:
        """Whether a document fails each rule, from its counts."""
        words = F.col("n_words")
        length = F.col("word_chars")
        return {
            "short": words < self.min_words,
            "repeats": 100 * F.col("n_repeat_words") > self.max_repeat_percent * words,
            "symbols": 100 * F.col("n_symbols") > self.max_symbol_percent * words,
            "lines": F.col("n_dup_lines") > self.max_dup_lines,
            "word_length": (length < self.min_word_chars * words) | (length > self.max_word_chars * words),
        }


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def windows(words: Column, of: Callable[..., Column], kind: str) -> Column:
    """``of`` the three words from each place on; none with fewer than three words."""
    places = F.sequence(F.lit(0), F.size(words) - 3)
    every = F.transform(places, lambda i: of(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, every).otherwise(F.array().cast(f"array<{kind}>"))


def words_in_repeats(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    Windows are compared by hash first; only where two hashes agree are they sorted by their words, and neighbours
    compared.
    """

    def covered(ordered: Column) -> Column:
        alike = F.filter(
            ordered,
            lambda w, k: (w.words == F.get(ordered, k - 1).words) | (w.words == F.get(ordered, k + 1).words),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(alike, lambda w: F.array(w.at, w.at + 1, w.at + 2)))))

    def compared(words: Column) -> Column:
        texts = windows(words, lambda a, b, c: F.concat_ws(" ", a, b, c), "string")
        return let(F.sort_array(F.transform(texts, lambda w, i: F.struct(w.alias("words"), i.alias("at")))), covered)

    return let(
        windows(words, F.xxhash64, "bigint"),
        lambda hashes: F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), 0).otherwise(compared(words)),
    )


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))
    return let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def counted(docs: DataFrame, rules: Rules, keep: list[Column], text: str = "text") -> DataFrame:
    """Columns ``keep``, then the counts of each text and whether the document fails on its own.

    A null text counts as empty. The counts come out of a generator, so the optimizer cannot compute them twice.
    """

    def measured(text: Column) -> Column:
        return let(
            words_of(text),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                repeated_lines(text).cast("long").alias("n_dup_lines"),
                words_in_repeats(words).cast("long").alias("n_repeat_words"),
            ),
        )

    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    failures = rules.failures()
    failed = failures["short"] | failures["repeats"]
    return docs.select(*keep, F.inline(F.transform(F.array(plain), measured))).withColumn("base_failed", failed)


def host_rates(judged: DataFrame, rules: Rules) -> DataFrame:
    """host, rule, number of documents, failures. A host of a third of all documents sends one row a task."""
    sums = [F.sum(failed.cast("long")).alias(rule) for rule, failed in rules.failures().items()]
    by_host = judged.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"), *sums)
    return by_host.unpivot(["host", "n"], list(rules.failures()), "rule", "failures").select("host", "rule", "n", "failures")


def beta_priors(rates: DataFrame) -> dict[str, tuple[float, float]]:
    """Parameters of the beta distribution of the hosts' rates of each rule, by its first two moments.

    The spread between hosts is the weighted spread of their raw rates less what chance alone gives; hosts that chance
    alone could explain get the strongest prior, so all of them take the common rate. One row a rule reaches the driver.
    """
    sums = rates.groupBy("rule").agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").cast("double").alias("n"),
        F.sum("failures").cast("double").alias("failures"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum(F.col("failures").cast("double") * F.col("failures") / F.col("n")).alias("weighted"),
    )
    priors = {}
    for row in sums.collect():
        mean = row.failures / row.n
        chance = mean * (1 - mean)
        spread = row.weighted - row.n * mean * mean
        room = row.n - row.squares / row.n - (row.hosts - 1)
        between = (spread - (row.hosts - 1) * chance) / room if room > 0 else 0.0
        strength = min(max(chance / between - 1, 1.0), 1e6) if between > 0 else 1e6
        priors[row.rule] = (mean * strength, (1 - mean) * strength)
    return priors


def rejected_hosts(rates: DataFrame, rules: Rules) -> DataFrame:
    """Hosts whose shrunk rate of failures of a rule is over its limit."""
    priors = beta_priors(rates)
    over = F.lit(False)
    for rule, limit in rules.host_limits:
        alpha, beta = priors.get(rule, (1.0, 1.0))
        shrunk = (F.col("failures") + alpha) / (F.col("n") + alpha + beta)
        over = over | ((F.col("rule") == rule) & (shrunk > limit))
    return rates.where(over).select("host").distinct()


def judge(docs: DataFrame, rules: Rules = Rules(), host: str = "source", text: str = "text", keep: str = "*") -> DataFrame:
    """One row per document: ``doc`` (a struct of the columns ``keep``), the counts, base_failed and kept.

    Texts are measured once and stored with their verdict; host rates are read from that table, and host verdicts
    joined back to it. The table of rejected hosts is stored too, so that Spark knows its size when it plans the join,
    and a host with a third of all documents is split if the join shuffles. Documents without a host are judged on
    their own only. Repeated rows are judged each, no documents give no rows, and columns of any name ride along.
    """
    own = F.struct(keep).alias("doc") if keep == "*" else F.struct(*keep.split(",")).alias("doc")
    judged = stored(counted(docs, rules, [own, F.col(host).cast("string").alias("host")], text), "judged-documents")
    rejected = stored(rejected_hosts(stored(host_rates(judged, rules), "host-rates"), rules), "rejected-hosts")
    verdicts = judged.join(rejected.withColumn("host_rejected", F.lit(True)), "host", "left")
    kept = ~F.col("base_failed") & F.col("host_rejected").isNull()
    return verdicts.select("doc", "host", *COUNTS, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, rules: Rules = Rules(), host: str = "source", text: str = "text") -> DataFrame:
    """The documents that pass their own rules and come from a host that is not rejected, with all their columns."""
    return judge(docs, rules, host, text).where("kept").select("doc.*")
