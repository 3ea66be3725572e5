"""Licence scans: a trained classifier of stretches of text, in DataFrame operations only.

Windows of words, each overlapping the next by half, cover the whole text across its line breaks. A
multinomial logistic regression on sparse counts of words and word pairs names the licence family
of a window, or none. It is trained on windows that hold noisy variants of the families' templates
among words of the corpus, and on a bounded sample of the corpus's own windows as the class of no
licence; its terms are all words and pairs of the templates. What it takes for a licence must be
likelier than a bound, which is calibrated on sampled windows held out of the training. Then
the window is compared with the templates of all families: the prediction is confirmed if the one
it is most like is of the predicted family and like enough. Between a family and a special one of
it (``SPECIAL``) the templates decide.

Windows without any word of ``MARKERS`` are of no licence and are not classified: any 32 words of a
template hold one.
"""

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ohlcraft.llm.common import stage
from ohlcraft.llm.licence_texts import MARKERS, SPECIAL, TEMPLATES

NONE = "none"
FAMILIES = [NONE, *TEMPLATES]
#: Words of a window, and from one window's start to the next one's.
WINDOW, STEP = 32, 16


@dataclass(frozen=True)
class Settings:
    #: Variants made of each stretch of a template, and the share of words each drops or adds, in percent.
    variants: int = 12
    noise: int = 8
    #: Documents whose windows are the sample of no licence; a quarter is held out.
    background: int = 600
    #: Windows of the sample that have no marker: so many are trained on, too.
    plain: int = 2000
    iterations: int = 40
    #: Held-out windows that may pass for a licence.
    mistaken: float = 0.002
    #: Share of a window's word pairs that a template must hold, or of a template's that the window
    #: must hold.
    confirmed: float = 0.6
    seed: int = 20_015


def words(text: Column) -> Column:
    """ASCII words and numbers in lower case."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.]+|\.+(?![0-9])"), lambda w: w != "")


def pairs(found: Column) -> Column:
    """Neighbouring words, joined by a blank."""
    return F.when(F.size(found) < 2, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(found) - 1), lambda i: F.concat_ws(" ", F.get(found, i - 1), F.get(found, i))))


def _marker_pattern() -> str:
    """Finds all texts with a marker, and some others where one is part of a longer word. By first
    letters, so that most places of a text are passed over quickly."""
    by_letter: dict[str, list[str]] = {}
    for marker in sorted(set(MARKERS)):
        by_letter.setdefault(marker[0], []).append(marker[1:] + ("(?![a-z])" if len(marker) < 4 else ""))
    return "(?i)(?:" + "|".join(f"{letter}(?:{'|'.join(ends)})" for letter, ends in by_letter.items()) + ")"


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marked: bool = True) -> DataFrame:
    """doc_id, first_word (its place in the text, from 0), words: windows that cover the whole text;
    only those with a marker, if ``marked``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    markers = F.array(*map(F.lit, sorted(set(MARKERS))))
    found = words(F.col("text"))
    if marked:  # most texts hold none, and are not split (as they would be ahead of a filter)
        found = F.when(F.col("text").rlike(_marker_pattern()), found)
    rows = rows.select("doc_id", found.alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - STEP - 1, F.lit(0)), F.lit(STEP))
    rows = rows.select("doc_id", "all", F.explode(starts).alias("first_word")).select(
        "doc_id", "first_word", F.slice("all", F.col("first_word") + 1, WINDOW).alias("words"))
    return rows.where(F.arrays_overlap("words", markers)) if marked else rows


def _with_terms(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pairs", pairs(F.col("words"))).withColumn("terms", F.concat("words", "pairs"))


def _driver_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9.]+|\.+(?![0-9])", text.lower()) if w]


def _stretches() -> list[tuple[str, list[str]]]:
    """The templates cut as texts are, shorter ones whole."""
    return [(family, found[at:at + WINDOW]) for family, texts in TEMPLATES.items() for found in map(_driver_words, texts)
            for at in range(0, max(len(found) - STEP, 1), STEP)]


def _kin(family: str) -> str:
    return SPECIAL.get(family, family)


def _template_pairs(spark: SparkSession) -> DataFrame:
    """pair, template, of (its family), held (distinct pairs of the template), own (whether no family
    but this one, or a special one of it, holds the pair): some thousand rows."""
    templates = [(family, {f"{a} {b}" for a, b in zip(found, found[1:])})
                 for family, texts in TEMPLATES.items() for found in map(_driver_words, texts)]
    holders: dict[str, set[str]] = {}
    for family, own in templates:
        for pair in own:
            holders.setdefault(pair, set()).add(family)
    rows = [(pair, number, family, len(own), holders[pair] <= {family} or (
                family not in SPECIAL and {_kin(f) for f in holders[pair]} == {family}))
            for number, (family, own) in enumerate(templates) for pair in sorted(own)]
    return spark.createDataFrame(rows, "pair string, template int, of string, held int, own boolean")


def likeness(rows: DataFrame) -> DataFrame:
    """Rows with a unique ``key`` and ``pairs``: key, like (the share of word pairs of the shorter of
    window and template that both hold, for the template most like it), of (its family; among
    equals that of the most shared pairs). Only templates count of which the window holds a pair that
    no other family has. No row for windows without such a template."""
    own = rows.select("key", F.array_distinct("pairs").alias("held_here")).select(
        "key", F.size("held_here").alias("n"), F.explode("held_here").alias("pair"))
    shared = own.join(F.broadcast(_template_pairs(rows.sparkSession)), "pair").groupBy("key", "template").agg(
        F.count(F.lit(1)).alias("both"), F.first("of").alias("of"), F.first("held").alias("held"), F.first("n").alias("n"),
        F.max("own").alias("own")).where("own")
    like = (F.col("both") / F.least("held", "n")).alias("like")
    return shared.groupBy("key").agg(F.max(F.struct(like, F.col("both"), F.col("of"))).alias("best")).select(
        "key", "best.like", "best.of")


def _variants(background: DataFrame, settings: Settings) -> DataFrame:
    """family, words: each stretch of a template many times, with words dropped and added, and
    windows of the corpus around the shorter ones; all chosen by hash."""
    spark = background.sparkSession
    around = [r.words for r in background.orderBy(F.xxhash64("words", F.lit(settings.seed))).limit(200).collect()] or [["word"]]
    rows = spark.createDataFrame(
        [(family, found, i) for i, (family, found) in enumerate(_stretches())], "family string, own array<string>, stretch int")
    rows = rows.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(settings.variants - 1))))
    draw = lambda n, *x: F.pmod(F.xxhash64(F.lit(settings.seed), "stretch", "variant", *x), F.lit(n))
    others = F.array(*(F.array(*map(F.lit, w)) for w in around))
    other = F.get(others, draw(len(around)).cast("int"))
    kept = F.filter("own", lambda w, i: (F.col("variant") == 0) | (draw(100, i) >= settings.noise))
    before = F.when(F.col("variant") % 2 == 0, 0).otherwise(draw(WINDOW, F.lit("before"))).cast("int")
    room = F.greatest(F.lit(WINDOW) - F.size("kept"), F.lit(0))
    ahead = F.slice("other", F.lit(1), F.least("before", room))
    behind = F.when(F.col("variant") % 3 == 0, F.array().cast("array<string>")).otherwise(
        F.slice("other", F.least("before", room) + 1, F.greatest(room - F.col("before"), F.lit(0))))
    return rows.select("family", kept.alias("kept"), other.alias("other"), before.alias("before"), "variant").select(
        "family", F.concat(ahead, "kept", behind).alias("words"))


@dataclass(frozen=True)
class Classifier:
    vectorizer: CountVectorizerModel
    model: LogisticRegressionModel
    bound: float

    def predicted(self, rows: DataFrame) -> DataFrame:
        """Rows with terms, and their family (null: none) and its probability."""
        rows = self.model.transform(self.vectorizer.transform(rows)).withColumn(
            "chances", vector_to_array("probability"))
        best = F.array_max(F.slice("chances", 2, len(FAMILIES) - 1))
        names = F.array(*map(F.lit, FAMILIES))
        family = F.when(best >= self.bound, F.get(names, F.array_position("chances", best).cast("int") - 1))
        return rows.withColumns({"family": family, "probability": best}).drop(
            "features", "rawPrediction", "prediction", "chances")


def train(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """A classifier for these documents, from the templates and ``background`` documents."""
    spark = docs.sparkSession
    order = F.xxhash64(F.lit(settings.seed), F.col(id_col))
    ids = [r[0] for r in docs.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(order, id_col).limit(
        settings.background).collect()]
    sampled = stage(docs.where(F.col(id_col).isin(ids)).select(id_col, text_col), "sampled")
    marked = stage(_with_terms(windows(sampled, id_col, text_col)).withColumn(
        "key", F.monotonically_increasing_id()), "marked")
    # what is nearly a template is no sample of no licence
    near = likeness(marked).where("like >= 0.5")
    own = marked.join(near, "key", "left_anti").select("words", "terms")
    plain = _with_terms(windows(sampled, id_col, text_col, marked=False)).select("words", "terms").orderBy(
        F.xxhash64("words", F.lit(settings.seed))).limit(settings.plain)
    plain = plain.where(~F.arrays_overlap("words", F.array(*map(F.lit, sorted(set(MARKERS))))))
    held_out = F.pmod(F.xxhash64(F.lit(settings.seed), "words"), F.lit(4)) == 0
    sample = stage(own.unionByName(plain).withColumn("held_out", held_out), "background")
    variants = _with_terms(_variants(sample.select("words"), settings)).select("family", "terms")
    rows = stage(variants.unionByName(
        sample.where("NOT held_out").select(F.lit(NONE).alias("family"), "terms")), "training")
    names = F.array(*map(F.lit, FAMILIES))
    rows = rows.withColumn("label", (F.array_position(names, F.col("family")) - 1).cast("double"))
    # the classifier's terms are those of the templates, all of them
    terms = _with_terms(spark.createDataFrame([(words,) for _, words in _stretches()], "words array<string>"))
    vectorizer = CountVectorizer(
        inputCol="terms", outputCol="features", vocabSize=1 << 18, minDF=1.0, binary=True).fit(terms)
    model = LogisticRegression(
        family="multinomial", maxIter=settings.iterations, regParam=1e-4, featuresCol="features", labelCol="label",
    ).fit(vectorizer.transform(rows))
    free = Classifier(vectorizer, model, 0.0).predicted(sample.where("held_out").select("terms"))
    bound = free.agg(F.percentile_approx("probability", F.lit(1 - settings.mistaken), F.lit(10_000))).first()[0]
    return Classifier(vectorizer, model, min(0.9, max(0.5, bound or 0.0)))


def scan(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
    classifier: Classifier | None = None,
) -> DataFrame:
    """A row per document: doc_id, n_windows (with a marker), n_licence (windows that the classifier
    names and the templates confirm), n_unconfirmed, families (of the confirmed, sorted; see
    ``SPECIAL``), probability and likeness (the largest of the confirmed) and first_word (where the
    first of them begins); the last three are null without one.

    Null or empty text: no windows. Null id: a row like others. Rows that repeat an id come
    as one, their windows together. Empty table: no rows. Other columns are not read.
    """
    classifier = classifier or train(docs, settings, id_col, text_col)
    found = classifier.predicted(_with_terms(windows(docs, id_col, text_col)))
    named = stage(found.select(
        "doc_id", "first_word", "family", "probability", F.when(F.col("family").isNotNull(), F.col("pairs")).alias("pairs"),
        F.monotonically_increasing_id().alias("key")), "classified")
    like = likeness(named.where("family IS NOT NULL"))
    kin = lambda c: F.coalesce(*(F.when(F.col(c) == f, g) for f, g in SPECIAL.items()), F.col(c))
    sure = F.coalesce((F.col("like") >= settings.confirmed) & (kin("of") == kin("family")), F.lit(False))
    rows = named.join(like, "key", "left").select(
        "doc_id", F.lit(1).alias("n"), F.when(sure, F.col("of")).otherwise(F.col("family")).alias("family"), "probability", F.col("like").alias("likeness"), "first_word", sure.alias("sure"))
    nothing = {"family": "string", "probability": "double", "likeness": "double", "first_word": "int"}
    rows = rows.unionByName(docs.select(
        F.col(id_col).alias("doc_id"), F.lit(0).alias("n"), F.lit(False).alias("sure"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in nothing.items())))
    number = lambda c: F.sum(c.cast("long"))
    if_sure = lambda c: F.when(F.col("sure"), F.col(c))
    families = F.sort_array(F.collect_set(if_sure("family")))
    whole = rows.groupBy("doc_id").agg(
        F.sum("n").alias("n_windows"), number(F.col("sure")).alias("n_licence"),
        number(F.col("family").isNotNull() & ~F.col("sure")).alias("n_unconfirmed"), families.alias("families"),
        F.max(if_sure("probability")).alias("probability"), F.max(if_sure("likeness")).alias("likeness"),
        F.min(if_sure("first_word")).alias("first_word"))
    names = F.col("families")
    for special, general in SPECIAL.items():
        names = F.when(F.array_contains("families", special), F.array_remove(names, general)).otherwise(names)
    return whole.withColumn("families", F.array_join(names, "; "))
