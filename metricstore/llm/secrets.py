"""Secret scans: candidate strings, and a random forest that removes false positives.

Everything here is DataFrame work in the JVM, the forest included.

A candidate is a word (delimited by white space) of 16 or more characters that
holds a digit, or with 20 or more ASCII letters in a row, or in an issuer's
format, or of 6 or more characters that is assigned to a name that speaks of
secrets or stands one or two words behind one.  Its features: length; digits,
capitals and hexadecimal digits as shares; changes between character classes
per character; the share of rare patterns of classes; the mean rarity of its
letter pairs, -log2 of a pair's share among all letter pairs of the corpus's
words of 3 to 12 letters (0 without a pair); the share of it that dictionary words cover; how it looks
as a path, URL or address; and whether the words beside it speak of secrets.
The dictionary is the ``dictionary_words`` most frequent words of the corpus,
counted over all documents.

The forest learns from labelled findings (features and ``label``).  Where none
are given, findings are labelled by the issuers' formats (``FORMATS``) and by
assignments to a name that speaks of secrets; a bounded sample of
``sample_findings`` of each label trains the forest, in the order of a hash.
With one label alone there is nothing to learn: that label is every score.

Defined results: null and empty texts give no rows; a word that repeats gives a
finding at each place; null ids pass through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.llm.store import stored
from metricstore.plans.scratch import scratch_path

LETTERS = r"[A-Za-z]{20,}"
#: Names that speak of secrets (fixed values), in any case.
NAMES_PATTERN = r"(passw(or)?d|passwd|pwd|secret|token|api_?key|access_?key|credential|auth)"
#: A text without this has no candidate: a long word, or a name that speaks of secrets.
ANY = r"[^\x20\x09-\x0D]{15}|" + NAMES_PATTERN
#: Issuers' formats of keys (fixed values).
FORMATS = r"^\W*(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_\-]{35})\W*$"
NAMES = r"(?i)" + NAMES_PATTERN
ASSIGNED = NAMES + r"\w*[\"'`]?[=:]."

FEATURES = ["length", "digits", "capitals", "hexadecimal", "changes", "rare_pairs", "rarity", "covered", "slashes", "address",
            "web", "assigned", "named_inside", "named_before", "named_after", "quoted"]


def _is_candidate(i: Column) -> Column:
    """Of the word with number i in ``words``; ``named``: whether each of them speaks of secrets."""
    word, size = F.get("words", i), F.length(F.get("words", i))
    behind = F.coalesce(F.get("named", i - 1), F.lit(False)) | F.coalesce(F.get("named", i - 2), F.lit(False))
    return (size >= 6) & (behind | (F.get("named", i) & word.rlike(ASSIGNED)) | ((size >= 15) & (
        ((size >= 16) & word.rlike("[0-9]")) | word.rlike(LETTERS) | word.rlike(FORMATS))))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, word, value, before2, before, after): a row per candidate; ``word`` counts words from 0."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.where(F.col(text).rlike("(?i)" + ANY)).select(F.col(doc_id).alias("doc_id"), words.alias("words"))
    rows = rows.withColumn("named", F.transform("words", lambda w: w.rlike(NAMES)))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), _is_candidate)
    found = F.transform(at, lambda i: F.struct(
        i.cast("long").alias("word"), F.get("words", i).alias("value"), F.coalesce(F.get("words", i - 2), F.lit("")).alias("before2"),
        F.coalesce(F.get("words", i - 1), F.lit("")).alias("before"), F.coalesce(F.get("words", i + 1), F.lit("")).alias("after")))
    return rows.where("size(words) > 0").select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.*")


def dictionary(docs: DataFrame, text: str = "text", most: int = 5000) -> DataFrame:
    """(term): the most frequent words of 3 to 12 letters, over all documents."""
    return _most(_terms(docs, text), most)


def _most(counts: DataFrame, most: int) -> DataFrame:
    return counts.orderBy(F.desc("count"), "term").limit(most).select("term")


def _terms(docs: DataFrame, text: str) -> DataFrame:
    """(term, count) of all words of 3 to 12 letters."""
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\b[a-z]{3,12}\b"), F.lit(0)))
    return docs.select(words.alias("term")).groupBy("term").count()


def _pairs(word: Column) -> Column:
    return F.regexp_extract_all(word, F.lit("(?=([a-z]{2}))"), F.lit(1))


def rarities(counts: DataFrame) -> DataFrame:
    """(pair, rarity) of all 676 pairs of letters, from (term, count): -log2 of (n + 0.5) / (sum of n + 338)."""
    letters = F.transform(F.sequence(F.lit(97), F.lit(122)), lambda c: F.chr(c))
    every = counts.sparkSession.range(1).select(F.explode(letters).alias("a")).select(
        "a", F.explode(letters).alias("b")).select(F.concat("a", "b").alias("pair"))
    n = counts.select(F.explode(_pairs(F.col("term"))).alias("pair"), "count").groupBy("pair").agg(F.sum("count").alias("n"))
    n = every.join(n, "pair", "left").select("pair", F.coalesce("n", F.lit(0)).alias("n"))
    return n.crossJoin(n.agg(F.sum("n").alias("all"))).select(
        "pair", (-F.log2((F.col("n") + 0.5) / (F.col("all") + 338))).alias("rarity"))


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def features(found: DataFrame, terms: DataFrame, rarity: DataFrame | None = None) -> DataFrame:
    """``found`` with FEATURES; ``terms`` (at most a few thousand rows) and ``rarity`` (by default of ``terms``) are broadcast."""
    rarity = rarities(terms.withColumn("count", F.lit(1))) if rarity is None else rarity
    parts = F.transform(F.regexp_extract_all("value", F.lit("[A-Za-z]{3,12}"), F.lit(0)), lambda x: F.lower(x))
    values = found.select("value").distinct()
    pieces = values.select("value", F.explode(parts).alias("term"))
    covered = (pieces.join(F.broadcast(terms), "term").groupBy("value")
               .agg(F.sum(F.length("term")).alias("n_covered")))
    two = values.select("value", F.explode(_pairs(F.lower(F.col("value")))).alias("pair"))
    rare = two.join(F.broadcast(rarity), "pair").groupBy("value").agg(F.avg("rarity").alias("mean_rarity"))
    named = lambda c: F.col(c).rlike(NAMES).cast("double")
    out = found.join(covered, "value", "left").join(rare, "value", "left")
    return out.select(
        *found.columns, F.length("value").cast("double").alias("length"), _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("capitals"), _share("[0-9a-f]").alias("hexadecimal"),
        _share("(?<=[a-z])(?=[0-9A-Z])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Z])(?=[0-9])").alias("changes"),
        _share("[bcdfghjklmnpqrstvwxz]{4,}|[0-9][a-z][0-9]|[A-Z][0-9][A-Z]").alias("rare_pairs"),
        F.coalesce("mean_rarity", F.lit(0.0)).alias("rarity"),
        (F.coalesce("n_covered", F.lit(0)) / F.length("value")).alias("covered"), _share("[/.]").alias("slashes"),
        F.col("value").rlike(r"^\S+@\S+\.\S+$").cast("double").alias("address"),
        F.col("value").rlike(r"(?i)://|^www\.").cast("double").alias("web"),
        (F.col("value").rlike("[=:].") | F.col("before").rlike("[=:]$")).cast("double").alias("assigned"),
        named("value").alias("named_inside"),
        F.greatest(named("before"), named("before2")).alias("named_before"), named("after").alias("named_after"),
        F.col("value").rlike("^[\"'`].*[\"'`],?;?$").cast("double").alias("quoted"))


def format_label() -> Column:
    assigned = (F.col("value").rlike(NAMES + r"\w*[=:]\S*[0-9]\S*")
                | ((F.col("before2").rlike(NAMES) | F.col("before").rlike(NAMES)) & F.col("before").rlike("[=:]$")
                   & F.col("value").rlike("[0-9]")))
    return (F.col("value").rlike(FORMATS) | assigned).cast("double")


def train(labelled: DataFrame, sample_findings: int = 2000, trees: int = 20, depth: int = 6, seed: int = 7):
    """A forest from rows with FEATURES and ``label`` (0 or 1), or the one label there is, or 0.0 without rows."""
    order = F.xxhash64("value", *FEATURES)
    sample = None
    for label in (0.0, 1.0):
        part = labelled.where(F.col("label") == label).select(*FEATURES, "label", order.alias("o"))
        part = part.orderBy("o", *FEATURES).limit(sample_findings).drop("o")
        sample = part if sample is None else sample.unionAll(part)
    sample = stored(sample, "secrets-sample")
    labels = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(labels) < 2:
        return labels[0] if labels else 0.0
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="vector", labelCol="label")
    fitted = forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample))
    # A fitted model keeps its training summary, which holds the session and cannot always go to tasks; a read one has none.
    path = scratch_path(labelled.sparkSession, "llm/secrets-forest")
    fitted.write().save(path)
    return RandomForestClassificationModel.load(path)


def score(found: DataFrame, model) -> DataFrame:
    """Rows with FEATURES, and ``score``: the forest's share of votes for a secret."""
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="vector")
    voted = model.transform(vector.transform(found))
    return voted.withColumn("score", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", labelled: DataFrame | None = None,
         threshold: float = 0.5, dictionary_words: int = 5000, sample_findings: int = 2000) -> DataFrame:
    """(doc_id, word, value, score, is_secret): a row per candidate of every text."""
    counts = stored(_terms(docs, text), "secrets-terms")
    terms = stored(_most(counts, dictionary_words), "secrets-dictionary")
    rarity = stored(rarities(counts), "secrets-rarities")
    found = stored(features(stored(candidates(docs, doc_id, text), "secrets-found"), terms, rarity), "secrets-candidates")
    if labelled is None:
        labelled = found.withColumn("label", format_label())
    model = train(labelled, sample_findings)
    return score(found, model).select("doc_id", "word", "value", "score", (F.col("score") >= threshold).alias("is_secret"))
