"""Quality rules whose cutoffs are chosen from labelled documents under a stated risk.

A rule rejects a document whose score is above a cutoff. For every stratum, rule and cutoff of a
fixed grid, the good labelled documents that would be lost are counted. A cutoff is admitted when
the exact binomial probability of losing so few, were the true loss above the limit, is at most
the error level divided by the number of all cutoffs tried (Bonferroni). The tightest admitted
cutoff of each rule is used; with none, the rule is off in that stratum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import WORD, held, let, whole, words, written

SYMBOLS = "#*$%&|<>"
# Score of the features, and the cutoffs tried, from the tightest on.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (0.05, 0.1, 0.2, 0.4, 0.8)),
    "dup_lines": ("n_dup_lines / n_lines", (0.1, 0.2, 0.3, 0.4, 0.6)),
    "repeats": ("n_repeat_words / n_words", (0.1, 0.2, 0.3, 0.4, 0.5)),
    "long_words": ("word_chars / n_words", (7.0, 8.0, 9.0, 10.0, 12.0)),
    "short_words": ("-word_chars / n_words", (-4.0, -3.5, -3.0, -2.5, -2.0)),
}
MAX_LOSS = 0.05
ERROR = 0.05


def repeated_words(ws: Column, k: int = 3) -> Column:
    """Words inside windows of ``k`` words that stand twice or more in the text.

    The windows' hashes are sorted with their places, so that equal ones are neighbours; sorted
    places of repeated windows then cover ``k`` words each, less what the next one covers.
    """
    n = F.size(ws)
    hashed = F.transform(
        F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
        lambda i: F.struct(F.xxhash64(*[F.get(ws, i + j) for j in range(k)]).alias("h"), i.alias("p")),
    )
    twice = lambda s: F.filter(
        s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | (F.get(s, i + 1)["h"] == x["h"])
    )
    cover = lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(k), F.get(p, i + 1) - x), F.lit(k))),
        F.lit(0), lambda a, x: a + x,
    )
    places = lambda s: F.sort_array(F.transform(twice(s), lambda x: x["p"]))
    return F.when(n >= k, let(let(F.sort_array(hashed), places), cover)).otherwise(0)


def features(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    A null text counts as empty and has 0 everywhere. Lines are those with a word. Columns of
    these names are replaced.
    """
    t = whole(docs[text])
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    chars = let(words(t), lambda w: F.struct(
        F.size(w).alias("n_words"),
        F.length(F.array_join(w, "")).alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    ))
    counted = let(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")
    ))
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [docs[c] for c in docs.columns if c not in names]
    out = held(docs.select(*kept, docs[text].alias("_q_text")) if text in names else docs.select(*kept),
               _q_words=chars, _q_lines=counted, _q_symbols=symbols)
    return out.select(
        *[c for c in docs.columns if c not in names],
        F.col("_q_words.n_words").cast("long").alias("n_words"),
        F.col("_q_words.word_chars").cast("long").alias("word_chars"),
        F.col("_q_symbols").cast("long").alias("n_symbols"),
        F.col("_q_lines.n_lines").cast("long").alias("n_lines"),
        F.col("_q_lines.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("_q_words.n_repeat_words").cast("long").alias("n_repeat_words"),
    )


def most_losses(n: Column, loss: float, error: Column) -> Column:
    """The largest k with P(Binomial(n, loss) <= k) <= error; -1 when even 0 losses prove nothing.

    The terms are summed from 0 losses up, each from the one before, in logarithms.
    """
    odds = loss / (1 - loss)
    start = F.struct(
        (n * F.log(F.lit(1 - loss))).alias("term"), F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("k")
    )

    def step(a: Column, i: Column) -> Column:
        total = a["sum"] + F.exp(a["term"])
        return F.struct(
            (a["term"] + F.log((n - i) / (i + 1) * F.lit(odds))).alias("term"),
            total.alias("sum"),
            F.when(total <= error, i).otherwise(a["k"]).alias("k"),
        )

    upto = F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(loss)).cast("long"))
    return F.aggregate(upto, start, step)["k"]


def cutoffs(
    labelled: DataFrame,
    stratum: str,
    rules: Mapping[str, tuple[str, Sequence[float]]] = RULES,
    max_loss: float = MAX_LOSS,
    error: float = ERROR,
) -> DataFrame:
    """One row per stratum of the good documents ``labelled``: ``_stratum`` and a cutoff per rule.

    The loss limit of a stratum is shared evenly by the rules, so that all rules together lose at
    most ``max_loss`` of its good documents, in all strata at once with probability 1 - ``error``.
    """
    share = max_loss / len(rules)
    lost = [
        F.count(F.when(F.expr(f"coalesce({score}, 0)") > F.lit(c), 1)).alias(f"_{rule}_{i}")
        for rule, (score, grid) in rules.items() for i, c in enumerate(grid)
    ]
    strata = labelled.groupBy(F.col(stratum).alias("_stratum")).agg(F.count(F.lit(1)).alias("n"), *lost)
    tests = sum(len(grid) for _, grid in rules.values())
    n_strata = strata.agg(F.count(F.lit(1))).scalar()
    allowed = held(
        strata.withColumn("strata", n_strata),
        most=most_losses(F.col("n"), share, F.lit(error) / (F.col("strata") * tests)),
    )
    best = [
        F.least(*[F.when(F.col(f"_{rule}_{i}") <= F.col("most"), F.lit(float(c))) for i, c in enumerate(grid)],
                F.lit(None).cast("double")).alias(f"_cut_{rule}")
        for rule, (_, grid) in rules.items()
    ]
    return allowed.select("_stratum", *best)


def judged(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    stratum: str,
    good: Column,
    rules: Mapping[str, tuple[str, Sequence[float]]] = RULES,
    max_loss: float = MAX_LOSS,
    error: float = ERROR,
) -> DataFrame:
    """``docs`` (with ``features``) plus ``base_failed`` and ``kept``.

    ``labels`` holds ``key`` and the columns of ``good``; a key with several labels is good when
    all say so, labels without key or verdict are left out. A null stratum is a stratum. Documents
    of a stratum without good labelled documents are judged by the base rule alone, as are all
    when ``labels`` is empty. Repeated rows are judged alike. Columns named like the two new ones
    or beginning with ``_cut_`` are replaced.
    """
    docs = docs.drop("base_failed", "kept", "_stratum", "_k", "_good", *[f"_cut_{r}" for r in rules])
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    rows = docs.withColumn("_stratum", F.coalesce(F.concat(F.lit("a"), docs[stratum].cast("string")), F.lit("b")))
    verdicts = labels.select(labels[key].alias("_k"), good.alias("_good"))
    verdicts = verdicts.groupBy("_k").agg(F.min("_good").alias("_good")).where("_good AND _k IS NOT NULL")
    good_rows = rows.where(~base).join(verdicts, rows[key] == F.col("_k"), "left_semi")
    # Written first: its size is then known, and the documents need not move to meet it.
    cut = written(cutoffs(good_rows, "_stratum", rules, max_loss, error), "cutoffs")
    over = [
        F.coalesce(F.expr(f"coalesce({score}, 0)") > F.col(f"_cut_{rule}"), F.lit(False))
        for rule, (score, _) in rules.items()
    ]
    rejected = reduce(lambda a, b: a | b, over)
    out = rows.join(cut, "_stratum", "left")
    return out.select(*docs.columns, base.alias("base_failed"), (~(base | rejected)).alias("kept"))
