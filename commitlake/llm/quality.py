"""Per-document text statistics and text types (prose, list, table, junk) by weak supervision.

The statistics are plain column expressions. Thresholds on them are noisy labelling functions, each voting for one type or
abstaining. Their accuracies are learned, without labels, by expectation-maximization on how they agree: documents are counted by
pattern of votes (the only thing that reaches the driver, bounded by the number of patterns), and each document gets the posterior of
every type from its votes.

Defined results: a null text has null statistics and no type; an empty or blank text is junk; repeated documents get equal rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.leakage import spread
from commitlake.session import bounded_collect, cut

TYPES = ["prose", "list", "table", "junk"]
#: Bound on patterns of votes collected (a function votes one type or abstains).
MAX_PATTERNS = 200_000
#: Words the list of common words may hold; it becomes part of a pattern.
MAX_COMMON = 2_000
ROUNDS = 60

# Characters that end a sentence or a clause.
ENDS = [".", "!", "?", ":", ";", ",", "…", "»", "”", '"', "'", ")"]

STATISTICS = [
    "n_chars", "n_words", "mean_word_length", "symbol_ratio", "digit_ratio", "line_end_ratio", "common_ratio",
    "prose_ratio", "list_ratio", "table_ratio", "distinct_ratio", "word_char_ratio", "fenced_ratio",
]


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of its text; line shares are by characters of the whole text; lines in closed fences are no prose."""
    common = sorted({r.word.lower() for r in bounded_collect(common_words.filter("word is not null").select("word").distinct(), MAX_COMMON)})
    base = documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain = base.withColumn("body", F.col("text")).withColumn("parts", F.split("text", "```"))  # every second part is fenced, the last one never
    is_common = lambda w: w.isin(common) if common else F.lit(False)
    item = r"^\s*(?:[-*+•–]\s|\(?\d{1,4}[.):]\s|\[[ xX]?\]\s|[A-Z?!]{1,2}\s{1,3}\S+/\S|[\w.-]+\s*(?:[=><~]=|[\^@])\s*v?\d|[\w./-]+\s+v?\d+\.\d+\S*\s*$|\S+\s*$)"
    many = lambda x, c, n: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit(""))) >= n

    def row(x: Column) -> Column:
        """A line of a table: between bars, or with several semicolons, tabs, commas without blanks, or wide gaps."""
        commas = many(x, ",", 3) & F.regexp_like(x, F.lit(r"^[^,]+(?:,[^,\s][^,]*){3}"))
        gaps = x.contains("  ") & F.regexp_like(x, F.lit(r"^\S+(?: \S+)*(?: {2,}\S+){2}"))
        return (F.ltrim(x).startswith("|") & F.rtrim(x).endswith("|")) | many(x, ";", 3) | many(x, "\t", 2) | commas | gaps

    lines = lambda part, i: F.transform(
        F.filter(F.split(part, r"\r\n|\n|\r"), lambda x: F.trim(x) != ""),
        lambda x: F.struct(
            ((i % 2 == 1) & (i < F.size("parts") - 1)).alias("fenced"),
            F.length(x).cast("double").alias("size"), F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("words"),
            F.regexp_like(x, F.lit(item)).alias("item"), row(x).alias("row"), F.right(F.rtrim(F.replace(x, F.lit("\t"), F.lit(" "))), F.lit(1)).isin(ENDS).alias("ends"),
        ),
    )
    seen = F.flatten(F.transform("parts", lines))
    # a line reads as a sentence with five words of two or more characters, two of them common
    judged = F.transform("seen", lambda x: F.struct(
        x["size"].alias("size"), x["fenced"].alias("fenced"), x["item"].alias("item"), x["row"].alias("row"), x["ends"].alias("ends"),
        F.size(F.filter(x["words"], is_common)).alias("common"), F.size(F.filter(x["words"], lambda w: F.length(w) >= 2)).alias("long"),
    ))
    total = lambda f: F.aggregate("judged", F.lit(0.0), lambda acc, x: acc + f(x))
    share = lambda test: _ratio(total(lambda x: F.when(test(x), x["size"]).otherwise(0.0)), F.col("chars"))
    n_words, solid, letters = F.col("n_words"), F.col("solid"), F.col("letters")
    left = lambda text, pattern: F.length(F.regexp_replace(text, pattern, "")).cast("double")
    return (
        plain.withColumn("seen", seen)
        .withColumns({"judged": judged, "tokens": F.flatten(F.transform("seen", lambda x: x["words"])), "alnum": F.regexp_replace("body", r"[^\p{L}\p{N}]+", "")})
        .withColumns({
            "n_words": F.size("tokens").cast("double"), "letters": F.length("alnum").cast("double"), "plain_letters": left("alnum", r"\p{N}+"), "solid": left("body", r"\s+"),
            "chars": F.aggregate("judged", F.lit(0.0), lambda acc, x: acc + x["size"]), "chunks": F.size(F.split(F.trim("body"), r"\s+")).cast("double"),
        })
        .select(
            "doc_id", "text", F.length("body").cast("double").alias("n_chars"), "n_words",
            _ratio(letters, n_words).alias("mean_word_length"),
            _ratio(solid - letters, solid).alias("symbol_ratio"),
            _ratio(letters - F.col("plain_letters"), solid).alias("digit_ratio"),
            _ratio(total(lambda x: F.when(x["ends"], 1.0).otherwise(0.0)), F.size("judged").cast("double")).alias("line_end_ratio"),
            _ratio(total(lambda x: x["common"]), n_words).alias("common_ratio"),
            share(lambda x: ~x["fenced"] & (x["common"] >= 2) & (x["long"] >= 5)).alias("prose_ratio"),
            share(lambda x: x["fenced"]).alias("fenced_ratio"),
            share(lambda x: x["item"]).alias("list_ratio"),
            share(lambda x: x["row"]).alias("table_ratio"),
            _ratio(F.size(F.array_distinct("tokens")).cast("double"), n_words).alias("distinct_ratio"),
            F.least(_ratio(F.size(F.filter("tokens", lambda w: (F.length(w) >= 2) & ~F.regexp_like(w, F.lit(r"\p{N}")))).cast("double"), F.col("chunks")), F.lit(1.0)).alias("word_char_ratio"),
        )
        .withColumns({s: F.when(F.col("text").isNotNull(), F.col(s)) for s in STATISTICS})
        .drop("text")
    )


def votes() -> dict[str, Column]:
    """The labelling functions: each a threshold on statistics, voting the index of a type, or -1."""
    c = F.col
    vote = lambda *cases: F.coalesce(*[F.when(cond, TYPES.index(t)) for cond, t in cases], F.lit(-1))
    return {
        "lf_prose_lines": vote((c("prose_ratio") >= 0.5, "prose"), (c("prose_ratio") < 0.1, "junk")),
        "lf_common": vote((c("common_ratio") >= 0.15, "prose"), (c("common_ratio") < 0.04, "junk")),
        "lf_line_end": vote(((c("line_end_ratio") >= 0.5) & (c("common_ratio") >= 0.1), "prose")),
        "lf_list_lines": vote(((c("list_ratio") >= 0.5) & (c("distinct_ratio") > 0.15), "list")),
        "lf_list_clean": vote(((c("list_ratio") >= 0.5) & (c("prose_ratio") < 0.5) & (c("mean_word_length") < 12) & (c("symbol_ratio") < 0.45), "list")),
        "lf_table_lines": vote((c("table_ratio") >= 0.5, "table")),
        "lf_table_digits": vote(((c("table_ratio") >= 0.5) & (c("digit_ratio") > 0.03) & (c("prose_ratio") < 0.5), "table")),
        "lf_symbols": vote((c("symbol_ratio") >= 0.4, "junk"), ((c("symbol_ratio") < 0.12) & (c("word_char_ratio") > 0.75), "prose")),
        "lf_fenced": vote((c("fenced_ratio") >= 0.5, "junk")),
        "lf_repeats": vote(((c("distinct_ratio") < 0.15) & (c("n_words") >= 8), "junk")),
        "lf_no_words": vote((c("word_char_ratio") < 0.25, "junk"), (c("word_char_ratio") > 0.85, "prose")),
        "lf_word_length": vote(((c("mean_word_length") > 14) | (c("mean_word_length") < 1.6), "junk")),
        "lf_digits": vote((c("digit_ratio") >= 0.5, "junk"), (c("digit_ratio") < 0.01, "prose")),
    }


def learn(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximization: type priors and ``p(vote | type)`` of every function, from the agreement of votes alone.

    ``patterns``: one row per pattern, votes -1..; starts from a majority vote, with add-one smoothing.
    """
    k, m, t = len(patterns), patterns.shape[1], len(TYPES)
    onehot = np.stack([patterns == v for v in range(-1, t)], axis=2).astype(float)  # pattern, function, vote
    tally = onehot[:, :, 1:].sum(axis=1) + 0.1
    posterior = tally / tally.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        weight = posterior * counts[:, None]
        priors = (weight.sum(axis=0) + 1) / (counts.sum() + t)
        emission = np.einsum("pt,pmv->tmv", weight, onehot) + 0.5
        emission /= emission.sum(axis=2, keepdims=True)
        log_p = np.log(priors)[None, :] + np.einsum("tmv,pmv->pt", np.log(emission), onehot)
        log_p -= log_p.max(axis=1, keepdims=True)
        posterior = np.exp(log_p)
        posterior /= posterior.sum(axis=1, keepdims=True)
    return priors, emission if k else np.full((t, m, t + 1), 1 / (t + 1))


def pattern(functions: dict[str, Column]) -> Column:
    """All votes of a document as one number, a digit per function."""
    key = F.lit(0).cast("bigint")
    for v in functions.values():
        key = key * (len(TYPES) + 1) + (v + 1).cast("bigint")
    return key


def digits(keys: list[int], n: int) -> np.ndarray:
    """The votes of patterns, a row each."""
    base = len(TYPES) + 1
    return np.array([[k // base ** (n - 1 - j) % base - 1 for j in range(n)] for k in keys], dtype=int).reshape(len(keys), n)


def posteriors(patterns: np.ndarray, priors: np.ndarray, emission: np.ndarray) -> np.ndarray:
    """The posterior of every type for each pattern."""
    log_p = np.log(priors)[None, :] + sum((np.log(emission[:, j, :][:, patterns[:, j] + 1]).T for j in range(patterns.shape[1])), np.zeros((len(patterns), len(TYPES))))
    log_p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
    return log_p / log_p.sum(axis=1, keepdims=True)


def classify(stats: DataFrame) -> DataFrame:
    """Add the posterior of each type (``p_<type>``) and ``text_type``, null where the text is null.

    Documents of equal votes have equal posteriors, so these are computed once per pattern and joined back.
    """
    functions = votes()
    voted = cut(stats.withColumn("__votes", F.when(F.col("n_chars").isNotNull(), pattern(functions))))
    counted = bounded_collect(voted.filter("__votes is not null").groupBy("__votes").count(), MAX_PATTERNS)
    patterns = digits([r["__votes"] for r in counted], len(functions))
    told: list = []
    if counted:
        voting = (patterns >= 0).any(axis=0)  # a function that never votes tells nothing
        used = patterns[:, voting] if voting.any() else patterns
        told = posteriors(used, *learn(used, np.array([r["count"] for r in counted], dtype=float))).tolist()
    table = [(r["__votes"], *p, TYPES[int(np.argmax(p))]) for r, p in zip(counted, told)]
    known = stats.sparkSession.createDataFrame(table, "__votes bigint, " + ", ".join(f"p_{t} double" for t in TYPES) + ", __type string")
    joined = voted.join(F.broadcast(known), "__votes", "left")  # at most MAX_PATTERNS rows
    return joined.withColumn("text_type", F.when(F.col("n_chars").isNotNull() & (F.col("n_words") == 0), "junk").otherwise(F.col("__type"))).drop("__votes", "__type")


def text_types(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, the posteriors and ``text_type``."""
    return classify(statistics(spread(documents.select("doc_id", "text")), common_words))
