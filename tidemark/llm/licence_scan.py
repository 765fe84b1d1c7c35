"""Licence notices in paragraphs: a trained classifier, confirmed by templates.

Paragraphs are the lines of a text. A logistic regression over sparse word one- and
two-grams names the family of each, or "unknown"; it is trained when called, on variants
of public notices and on a bounded sample of the given paragraphs. A part of that sample
is held out: the probability from which a family is taken lies above what held-out
paragraphs reach, which calibrates the unknown class. A prediction stands once enough of
a template's two-grams are found in the paragraph, or of the paragraph's in a template.

All of it runs in DataFrame operations of the engine; only lines that were taken for
notices meet the templates, and only a row per document is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.licence_templates import OTHERS, TEMPLATES
from tidemark.sources.scratch import materialize

UNKNOWN = "unknown"


@dataclass(frozen=True)
class LicenceRules:
    features: int = 1 << 12
    # Paragraphs of the corpus to train with, about so many different ones at most.
    sample: int = 4_000
    # Variants of a template, all but the first without one word in so many.
    variants: int = 8
    left_out: int = 6
    iterations: int = 40
    regularisation: float = 1e-3
    # A family needs at least this probability, and more where held-out paragraphs have more.
    least_probability: float = 0.5
    held_out_quantile: float = 0.999
    # Share of two-grams that confirms.
    confirmed_from: float = 0.6


def words_of(line: Column) -> Column:
    """Lower-case runs of letters, digits, dots and hyphens, without dots at the end."""
    cut = F.split(F.lower(F.coalesce(line, F.lit(""))), r"[^\p{L}\p{N}.-]+|\.+(?=\s|$|[^\p{L}\p{N}])")
    return F.filter(cut, lambda word: word != "")


def pairs_of(words: Column) -> Column:
    """Neighbouring words joined; a single word stands for itself."""
    both = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(F.size(words) == 1, words).otherwise(both)


def _literal_rows(spark: SparkSession, rows: tuple) -> DataFrame:
    """A small table of fixed (family, text) rows, made of expressions."""
    values = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in rows))
    return spark.range(1).select(F.explode(values).alias("row")).select("row.*")


def template_pairs(spark: SparkSession) -> list[tuple[str, list[str]]]:
    """Family and distinct two-grams of each of the templates, a fixed small number."""
    rows = _literal_rows(spark, TEMPLATES).select(
        "family", F.array_distinct(pairs_of(words_of(F.col("text")))).alias("pairs")
    )
    return [(row["family"], row["pairs"]) for row in rows.collect()]


def _alike(known: list[list[str]], rules: LicenceRules) -> Column:
    """Whether the paragraph's two-grams match one of the templates."""
    arrays = F.array(*(F.array(*map(F.lit, pairs)) for pairs in known))
    return F.exists(arrays, lambda t: _match(F.col("pairs"), t) >= rules.confirmed_from)


def _with_grams(lines: DataFrame) -> DataFrame:
    """Add words, pairs and grams (both)."""
    return (
        lines.withColumn("words", words_of(F.col("line")))
        .withColumn("pairs", pairs_of(F.col("words")))
        .withColumn("grams", F.concat("words", "pairs"))
    )


def _hashing(rules: LicenceRules) -> HashingTF:
    return HashingTF(numFeatures=rules.features, binary=True, inputCol="grams", outputCol="features")


def _match(paragraph: Column, template: Column) -> Column:
    """Share of the shorter side's two-grams that the other side has."""
    common = F.size(F.array_intersect(paragraph, template))
    return common / F.greatest(F.least(F.size(F.array_distinct(paragraph)), F.size(template)), F.lit(1))


def _training_rows(lines: DataFrame, rules: LicenceRules) -> DataFrame:
    """family, grams and part ("train" or "held out")."""
    spark = lines.sparkSession
    dropped = F.filter(
        "words",
        lambda word: (F.col("variant") == 0)
        | (F.pmod(F.xxhash64(word, F.col("variant"), F.col("text")), F.lit(rules.left_out)) != 0),
    )
    notices = (
        _literal_rows(spark, (*TEMPLATES, *((UNKNOWN, text) for text in OTHERS)))
        .withColumn("words", words_of(F.col("text")))
        .withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(rules.variants - 1))))
        .withColumn("words", dropped)
        .select("family", F.concat("words", pairs_of(F.col("words"))).alias("grams"), F.lit("train").alias("part"))
    )
    total = lines.agg(F.approx_count_distinct(F.xxhash64("line"))).first()[0]
    steps = 1 << 30
    share = int(steps * min(1.0, rules.sample / max(total, 1)))
    chosen = lines.where(F.pmod(F.xxhash64("line"), F.lit(steps)) <= share).distinct()
    # Stored, so that what follows works on the sample's words and not on the lines.
    sampled, _ = materialize(_with_grams(chosen).select("line", "pairs", "grams"), "licence-sample")
    # A paragraph that is a notice itself must not count as none.
    alike = _alike([pairs for _, pairs in template_pairs(spark)], rules)
    part = F.when(F.pmod(F.xxhash64("line", F.lit(1)), F.lit(4)) == 0, "held out").otherwise("train")
    others = sampled.where(~alike).select(F.lit(UNKNOWN).alias("family"), "grams", part.alias("part"))
    return notices.union(others)


@dataclass(frozen=True)
class LicenceModel:
    families: tuple[str, ...]
    fitted: LogisticRegressionModel
    probability: float


def train_model(lines: DataFrame, rules: LicenceRules) -> LicenceModel:
    """Fit on notices and a bounded sample of the lines, calibrate on its held-out part."""
    families = (UNKNOWN, *sorted({family for family, _ in TEMPLATES}))
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    rows, _ = materialize(_training_rows(lines, rules).coalesce(4), "licence-training")
    featured = _hashing(rules).transform(rows.withColumn("number", number.cast("double")))
    regression = LogisticRegression(
        featuresCol="features", labelCol="number", family="multinomial",
        maxIter=rules.iterations, regParam=rules.regularisation, aggregationDepth=2,
    )
    fitted = regression.fit(featured.where("part = 'train'"))
    held_out = fitted.transform(featured.where("part = 'held out'"))
    highest = F.array_max(F.slice(vector_to_array("probability"), 2, len(families) - 1))
    reached = held_out.agg(F.percentile(highest, rules.held_out_quantile)).first()[0]
    return LicenceModel(families, fitted, max(rules.least_probability, reached or 0.0))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_id, doc_id, paragraph (from 0) and line; a document without text has one row."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.split(F.col(text_col), "\n").alias("lines"),
    )
    return rows.select("row_id", "doc_id", F.posexplode_outer("lines").alias("paragraph", "line"))


def scan_licences(
    docs: DataFrame, rules: LicenceRules | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_paragraphs (with a word), n_predicted, n_confirmed, families and notices
    (paragraph:family, confirmed ones) for every row.

    A null or empty text has no paragraphs; repeated rows and null ids are rows of their
    own; other columns are not read; an empty table gives an empty result. Of equal
    probabilities the family first by name is taken. Training runs when this is called.
    """
    rules = rules or LicenceRules()
    lines = paragraphs(docs, id_col, text_col)
    model = train_model(lines.where("line is not null and line <> ''").select("line"), rules)
    featured = _hashing(rules).transform(_with_grams(lines))
    scored = model.fitted.transform(featured)
    chances = F.slice(vector_to_array("probability"), 2, len(model.families) - 1)
    names = F.array(*map(F.lit, model.families[1:]))
    named = scored.select(
        "row_id", "doc_id", "paragraph", "pairs", (F.size("words") > 0).alias("has_words"), chances.alias("chances")
    ).withColumn(
        "family",
        F.when(
            F.col("has_words") & (F.array_max("chances") >= model.probability),
            F.element_at(names, F.array_position("chances", F.array_max("chances")).cast("int")),
        ),
    )
    known: dict[str, list[list[str]]] = {}
    for family, pairs in template_pairs(docs.sparkSession):
        known.setdefault(family, []).append(pairs)
    confirmed = F.lit(False)
    for family, pairs in known.items():
        confirmed = F.when(F.col("family") == family, _alike(pairs, rules)).otherwise(confirmed)
    found = F.when(confirmed, F.struct("paragraph", "family"))
    per_document = (
        named.withColumn("found", found)
        .groupBy("row_id", "doc_id")
        .agg(
            F.count(F.when(F.col("has_words"), 1)).alias("n_paragraphs"),
            F.count("family").alias("n_predicted"),
            F.count("found").alias("n_confirmed"),
            F.sort_array(F.collect_list("found")).alias("found"),
        )
    )
    return per_document.select(
        "doc_id",
        "n_paragraphs",
        "n_predicted",
        "n_confirmed",
        F.array_join(F.array_sort(F.array_distinct(F.col("found.family"))), ",").alias("families"),
        F.array_join(
            F.transform("found", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ","
        ).alias("notices"),
    )
