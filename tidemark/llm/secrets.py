"""Secret scans: regular expressions propose, a random forest disposes.

Patterns of known key formats, of assignments to secret-sounding names and of
long mixed tokens propose candidates with their exact spans. A random forest
over length, character transitions, dictionary coverage, path and neighbouring
words removes false positives. It is trained from labelled findings. Only
DataFrame functions (and Spark's own random forest) are used.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_sample, saved, table, text_or_empty
from tidemark.session import fresh_scratch

FIT_ROWS = 20_000  # labelled findings the forest is trained on, at most
DICTIONARY_WORDS = 500  # commonest neighbouring words
TREES, TREE_DEPTH = 30, 6
THRESHOLD = 0.5
NEAR_CHARS = 80  # characters looked at on either side
MASK = "[SECRET]"

# Formats that providers publish. No pattern ends inside a run of
# its characters: a longer one is a candidate as a whole, its length a feature.
FORMATS = (
    r"AKIA[0-9A-Z]{16}\w*+",
    r"gh[pousr]_[A-Za-z0-9]{36}\w*+",
    r"xox[baprs]-[A-Za-z0-9-]{10}[\w-]*+",
    r"sk_live_[A-Za-z0-9]{16}\w*+",
    r"AIza[0-9A-Za-z_-]{35,}+",
    r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+",
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[\s\S]*?-----END [A-Z ]{0,40}PRIVATE KEY-----",
)
NAMES = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)"
SEPARATOR = r"(?::|=>|=)"
# a comma or semicolon inside is part of the value, one at its end is not
BARE = r"""(?=[^\s"'<>]{6})[^\s"'<>,;]++(?:[,;]++[^\s"'<>,;]++)*+"""
# up to the closing quote of the line, which has no or an even number of backslashes before it; else of the paragraph
QUOTED = "|".join(rf"{q}(?!(?:[^{q}\\\n]|\\.){{0,5}}{q})[^\n]{{6,}}?(?={q})(?<=[^\\](?:\\\\){{0,50}})"
                  rf"|{q}(?![^{q}]*?\n[ \t\r]*\n)[^{q}]{{6,}}+(?={q})" for q in "\"'")
VALUE = rf"""(?:{QUOTED}|["']?{BARE})"""
HEAD = rf"""{NAMES}[\w-]*+["']?\s*+{SEPARATOR}\s*+"""
ASSIGNMENT = rf"""(?i:\b{HEAD}{VALUE})"""
RUN = r"(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
GENERIC = rf"(?<![A-Za-z0-9+/_-]){RUN}"
CANDIDATE = "|".join([*(rf"\b{f}" if f[0] != "-" else f for f in FORMATS), ASSIGNMENT, GENERIC])
FORMAT = "^(?:" + "|".join(FORMATS) + ")$"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|^<[a-z].*>$"

FEATURES = ("length", "log_length", "digits", "uppers", "lowers", "hex", "transitions", "vowel_steps",
            "distinct", "entropy", "dictionary", "path_test", "path_doc", "name_before", "separator_before",
            "placeholder", "quoted", "near_words", "is_format", "spaces")


def share(text: Column, pattern: str) -> Column:
    """Share of a text's characters that match a character class."""
    return 1 - F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def found(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """One row per candidate: ``_doc`` (hash of id and text), id, ``_at``
    (number in its text), span, kind, value and what stands around it."""
    text = text_or_empty(F.col(f"`{text_col}`"))
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit(None).cast("string")
    rows = (docs.select(F.col(f"`{id_col}`").alias("_id"), document_key(id_col, text_col).alias("_doc"),
                        F.lower(F.coalesce(path, F.lit(""))).alias("_path"), text.alias("_text"),
                        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("_c"))
            .filter(F.size("_c") > 0))
    # between[i] precedes candidate i: the spans follow from the lengths
    rows = rows.withColumn("_between", F.split("_text", CANDIDATE, -1))
    ends = F.expr("""aggregate(sequence(0, size(_c) - 1), named_struct('at', 0, 'ends', cast(array() as array<int>)),
                     (a, i) -> named_struct('at', a.at + length(_between[i]) + length(_c[i]),
                        'ends', array_append(a.ends, a.at + length(_between[i]) + length(_c[i])))).ends""")
    one = (rows.withColumn("_ends", ends)
           .select("_id", "_doc", "_path", "_between", "_ends", F.posexplode("_c").alias("_at", "_m"))
           .select("_id", "_doc", "_path", "_at", "_m", F.get("_ends", F.col("_at")).alias("_end"),
                   F.right(F.get("_between", F.col("_at")), F.lit(NEAR_CHARS)).alias("_before"),
                   F.left(F.get("_between", F.col("_at") + 1), F.lit(NEAR_CHARS)).alias("_after")))
    held = F.regexp_extract("_m", rf"""(?s)^(?i:{HEAD}["']?)(.*)$""", 1)
    is_format = F.col("_m").rlike(FORMAT)
    value = F.when(is_format | (held == ""), F.col("_m")).otherwise(held)
    return (one.withColumn("_value", value)
            .withColumn("_kind", F.when(is_format, "format").when(F.col("_value") != F.col("_m"), "assignment")
                        .otherwise("generic"))
            .withColumn("_name", F.substring(F.col("_m"), F.lit(1), F.length("_m") - F.length("_value")))
            .drop("_m"))


def document_key(id_col: str, text_col: str) -> Column:
    c, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return F.xxhash64(c.isNull(), c, t.isNull(), t)


def words(text: Column) -> Column:
    """Lower-case letter runs of three or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{3,}"), F.lit(0))


def dictionary(candidates: DataFrame, size: int = DICTIONARY_WORDS) -> list[str]:
    """The commonest words around all candidates, at most ``size``."""
    near = candidates.select(F.explode(F.array_distinct(F.concat(words(F.col("_before")), words(F.col("_after")))))
                             .alias("w"))
    top = near.groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [r["w"] for r in top.collect()]


def with_features(candidates: DataFrame, known: list[str]) -> DataFrame:
    v, low = F.col("_value"), F.lower("_value")
    n = F.greatest(F.length(v), F.lit(1)).cast("double")
    classes = F.translate(F.translate(F.translate(
        v, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26), "abcdefghijklmnopqrstuvwxyz", "a" * 26), "0123456789", "0" * 10)
    runs = F.length(F.regexp_replace(classes, r"(?s)(.)\1*", "x"))
    voiced = F.translate(F.translate(F.regexp_replace(low, "[^a-z]", ""), "aeiouy", "v" * 6),
                         "bcdfghjklmnpqrstwxz", "c" * 19)
    steps = F.length(F.regexp_replace(voiced, r"(.)\1*", "x"))
    chars = F.array_distinct(F.split(v, ""))
    entropy = F.aggregate(F.transform(chars, lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))) / n),
                          F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    lexicon = F.array(*map(F.lit, known)) if known else F.expr("cast(array() as array<string>)")
    covered = F.aggregate(F.filter(words(v), lambda w: F.array_contains(lexicon, w)), F.lit(0),
                          lambda a, w: a + F.length(w)) / n
    named = F.concat(F.right("_before", F.lit(24)), F.col("_name"))
    f = {
        "length": n, "log_length": F.log(n), "digits": share(v, "[0-9]"), "uppers": share(v, "[A-Z]"),
        "lowers": share(v, "[a-z]"), "hex": share(v, "[0-9a-fA-F]"), "transitions": (runs - 1) / n,
        "vowel_steps": steps / n, "distinct": F.size(chars) / n, "entropy": entropy, "dictionary": covered,
        "path_test": F.col("_path").rlike("test|fixture|mock|sample|example"), "path_doc":
        F.col("_path").rlike("doc|readme|tutorial|guide"),
        "name_before": named.rlike(f"(?i){NAMES}"), "separator_before": named.rlike(rf"{SEPARATOR}\s*[\"']?$"),
        "placeholder": v.rlike(PLACEHOLDER), "quoted": named.rlike("[\"'`]$"),
        "near_words": F.size(words(F.col("_before"))) + F.size(words(F.col("_after"))),
        # a quoted value can hold a format among other words
        "is_format": (F.col("_kind") == "format") | v.rlike("|".join(FORMATS)), "spaces": share(v, r"\s"),
    }
    return candidates.withColumns({f"f_{k}": c.cast("double") for k, c in f.items()})


def rule_label(c: DataFrame) -> Column:
    """Labelled findings where none are given: 1 for a published format or a
    mixed, disorderly value given to a secret-sounding name; 0 for plain
    numbers, placeholders, words and unnamed orderly tokens; else null."""
    mixed = (F.col("f_digits") > 0) & (F.col("f_digits") < 1)
    token = (F.col("f_spaces") == 0) | F.col("_value").rlike(f"{RUN}|{ASSIGNMENT}")  # words with a number are none
    return (F.when(F.col("f_placeholder") == 1, 0).when(F.col("f_digits") == 1, 0)
            .when(F.col("f_is_format") == 1, 1)
            .when((F.col("f_name_before") == 1) & mixed & token & (F.col("f_entropy") >= 2.8), 1)
            .when((F.col("f_dictionary") > 0.5) | (F.col("f_digits") == 0), 0)
            .when((F.col("f_name_before") == 0) & (F.col("f_entropy") < 3.0), 0))


def classify(candidates: DataFrame, labelled: DataFrame | None = None, fit_rows: int = FIT_ROWS,
             seed: int = 9) -> DataFrame:
    """Adds ``probability`` to candidates with features. ``labelled``: features
    and ``label``; by default the candidates that ``rule_label`` labels. At
    most ``fit_rows`` of each label, picked by a hash, are used; if only one
    label occurs, it is everyone's verdict where the rules are silent."""
    labelled = labelled if labelled is not None else candidates.withColumn("label", rule_label(candidates))
    cols = [f"f_{k}" for k in FEATURES]
    rows = labelled.filter("label is not null").select(
        F.col("label").cast("double").alias("label"), *cols, "_value", "_before")
    parts = [hashed_sample(rows.filter(F.col("label") == k), F.xxhash64(F.lit(seed), F.col("_value"), F.col("_before")),
                           fit_rows, cols).select("label", *cols) for k in (0.0, 1.0)]
    fit = saved(parts[0].union(parts[1]).coalesce(1), "secrets-labelled")
    seen = {r["label"] for r in fit.select("label").distinct().collect()}
    if len(seen) < 2:
        sure = F.lit(next(iter(seen), 0.0))
        return candidates.withColumn("probability", F.coalesce(rule_label(candidates).cast("double"), sure))
    vector = VectorAssembler(inputCols=cols, outputCol="_x")
    forest = RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=TREES, maxDepth=TREE_DEPTH,
                                    seed=seed, featureSubsetStrategy="sqrt").fit(vector.transform(fit))
    # read back from the shared folder: a fitted model holds its training session
    path = fresh_scratch(candidates.sparkSession, "secrets-forest")
    forest.write().save(path)
    forest = RandomForestClassificationModel.load(path)
    forest = forest.setProbabilityCol("_p").setPredictionCol("").setRawPredictionCol("")
    return (forest.transform(vector.transform(candidates))
            .withColumn("probability", vector_to_array("_p")[1]).drop("_x", "_p"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
         labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: ``_id``, ``_doc``, ``_at``, ``start`` and
    ``length`` of the value (code points), ``kind``, ``probability``,
    ``is_secret``, ``_name_length``.

    Null and empty texts have no candidates. Null ids and repeated rows are
    scanned like others. An empty table gives an empty result. Other columns
    are not read.
    """
    c = saved(found(docs, id_col, text_col, path_col), "secrets-found")
    c = saved(with_features(c, dictionary(c)), "secrets-features")
    return classify(c, labelled).select(
        "_id", "_doc", "_at", (F.col("_end") - F.length("_value")).cast("long").alias("start"),
        F.length("_value").cast("long").alias("length"), F.col("_kind").alias("kind"),
        F.round("probability", 6).alias("probability"), (F.col("probability") >= threshold).alias("is_secret"),
        F.length("_name").alias("_name_length"))


def op4_secret_forest(spark, sf_dir: str) -> DataFrame:
    """Candidates of all documents and which of them are secrets."""
    return scan(table(spark, sf_dir, "documents"), path_col="source").select(
        F.col("_id").alias("doc_id"), "start", "length", "kind", "probability", "is_secret")


def redacted(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, secrets masked, ``n_chars`` renewed.

    A document's verdicts (as many as it has secrets) are joined back as a map
    from the candidate's number to the length of the name before its value."""
    hits = (scan(docs, path_col="source").filter("is_secret").select("_doc", "_at", "_name_length").distinct()
            .groupBy("_doc").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_name_length"))).alias("_bad")))
    hits = saved(hits, "secrets-hits")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       document_key("doc_id", "text").alias("_key"))
    rows = rows.join(hits, rows["_key"] == hits["_doc"], "left")
    text = F.col("_row.text")
    # texts without secrets are passed through as they are
    rows = (rows.withColumn("_c", F.when(F.col("_bad").isNotNull(),
                                         F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))))
            .withColumn("_between", F.when(F.col("_bad").isNotNull(), F.split(text, CANDIDATE, -1))))
    masked = F.expr(f"""concat(array_join(transform(_c, (c, i) -> concat(_between[i],
        if(_bad[i] is null, c, concat(left(c, _bad[i]), '{MASK}')))), ''), _between[size(_c)])""")
    new = F.when(F.col("_bad").isNull(), text).otherwise(masked)
    return rows.withColumn("_new", new).select(*[
        F.col("_new").alias(c) if c == "text" else F.length("_new").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
