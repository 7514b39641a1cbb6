"""Rule-based text scoring.

Whole texts are scored where they lie: the dictionary words of a text are kept
as a small array in the row, so no tokens are exploded and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C

Lexicon = dict[int, tuple]


def tokens(text) -> Column:
    """Runs of the letters a to z in the lower-cased text."""
    return F.split(F.lower(text), "[^a-z]+")


def members(items, words) -> Column:
    """The items of an array that belong to a word list, repeats included."""
    return F.filter(items, lambda item: item.isin(*words))


def dictionary_words(text, words) -> Column:
    return members(tokens(text), words)


def with_sentiment(df: DataFrame, text: str, lexicon: Lexicon = rules.SENTIMENT_LEXICON,
                   name: str = "sentiment_score") -> DataFrame:
    """Add the mean polarity of a text's dictionary words: -1 to 1, four decimals.

    Weights are whole tenths, so the sums are exact. A text without any
    dictionary word scores 0; only a null text has no score. The words are
    picked out in a projection of their own, so a text is tokenised once.
    """
    words = [w for group in lexicon.values() for w in group]

    def weight_of(token: Column) -> Column:
        chain = F
        for weight, group in lexicon.items():
            chain = chain.when(token.isin(*group), F.lit(weight))
        return chain.otherwise(F.lit(0))

    picked = df.withColumn("_hits", dictionary_words(text, words))
    total = F.aggregate("_hits", F.lit(0), lambda acc, token: acc + weight_of(token))
    raw = C.safe_divide(total, F.size("_hits") * 10)
    averaged = picked.withColumn("_raw", raw)
    score = F.when(F.col(text).isNotNull(), F.coalesce(C.round_half_up("_raw", 4), F.lit(0.0)))
    return averaged.withColumn(name, score).drop("_hits", "_raw")


def sentiment_label(score) -> Column:
    positive, negative, neutral = rules.SENTIMENT_LABELS
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score >= rules.SENTIMENT_BOUND, positive)
        .when(score <= -rules.SENTIMENT_BOUND, negative)
        .otherwise(neutral)
    )


def root_causes(text) -> Column:
    """All stated root causes in order, each to the end of its sentence or of the text; null for a null text."""
    return F.transform(F.regexp_extract_all(text, F.lit(rules.ROOT_CAUSE), F.lit(1)), F.trim)


def sentences(text) -> Column:
    """Sentences of a text without their periods; a period inside a number ends none."""
    return F.filter(F.transform(F.split(text, rules.SENTENCE_END, -1), F.trim), lambda s: s != "")


def name_tokens(text) -> Column:
    """Runs of letters and digits of any script in the lower-cased text, as names of parts have them."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", -1), lambda t: t != "")


def with_text_category(df: DataFrame, text: str, categories: dict[str, tuple] = rules.TEXT_CATEGORIES,
                       default: str = rules.TEXT_CATEGORY_DEFAULT, name: str = "text_category") -> DataFrame:
    """Add the category with the most keyword hits; the earlier one wins a tie."""
    words = [w for group in categories.values() for w in group]
    picked = df.withColumn("_hits", dictionary_words(text, words))
    for i, group in enumerate(categories.values()):
        picked = picked.withColumn(f"_n{i}", F.size(members("_hits", group)))
    scores = [F.col(f"_n{i}") for i in range(len(categories))]
    best = F.greatest(*scores)
    chain = F.when(best.isNull() | (best <= 0), default)
    for category, score in zip(categories, scores):
        chain = chain.when(score == best, category)
    return picked.withColumn(name, chain).drop("_hits", *[f"_n{i}" for i in range(len(categories))])
