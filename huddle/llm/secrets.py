"""Secret scans: candidates judged by a random forest, DataFrame operations only.

A candidate is a run of 16 or more of ``A-Z a-z 0-9 + / _ -`` with a digit; a
word of the text may hold any number of them.  The forest sees its length, its
characters and the transitions between their kinds, how much of it dictionary
words cover, the path of the document and the words around it.

The text before a word's first run is the three words before and the word up
to the run; before a later one, the run before it and what stands between.
Runs that only a mark like ``.`` or ``,`` joins are parts of one value (a
JWT, a list): each stands where the value stands, with ``NEAR`` characters of
the text before it.

Labelled findings to train on: a sample of at most ``SAMPLE`` candidates of
the corpus (lowest hashes of id and place) gives the surroundings; in each,
findings of known label are put: credentials in the usual formats, and what
scanners mistake for them (digests, numbers, identifiers, placeholders, paths).
The corpus' own candidates add the clear cases: digits alone are no secret, a
mixed value assigned to a credential's name is one.  ``labelled`` findings of
another origin may be given instead.  Everything else runs over all texts.

Defined results: a null or empty text has no candidate; repeated rows each
have theirs; a null id stays null; a text without blanks is one word with all
its candidates; an empty table gives an empty result.  Only the id, text and
path columns are read.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from huddle.llm.shared import numbered, side, written

SAMPLE = 1_200
TREES = 24
DEPTH = 6
MASK = "[SECRET]"

NEAR = 200

# Whole runs, each character read a fixed number of times; possessive, so that long ones need no stack.
CANDIDATE = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{16,}+"
#: Candidates joined by a mark alone; the name of a value is none of them.
JOINED = CANDIDATE + r"(?:=*+[\"'`]?+[.,;|~][\"'`]?+" + CANDIDATE + r"(?![\"'`]?:|=\w))*+"
# Words of the scan's dictionary and of a candidate's surroundings.
DICTIONARY = (
    "example|sample|test|dummy|fake|mock|demo|your|here|change|changeme|insert|replace|placeholder|value|token|secret|password|passwd|"
    "api|key|access|client|server|user|name|admin|login|auth|account|service|project|version|release|build|commit|branch|master|main|"
    "index|page|image|file|path|home|data|table|column|http|https|www|com|org|html|json|config|default|local|public|private|notes|"
    "january|february|march|april|june|july|august|september|october|november|december|lorem|ipsum|foo|bar|baz|hello|world|none|null|true|false"
)
CREDENTIAL = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer)"
HARMLESS = r"(?:commit|sha1?|sha-?256|md5|hash|digest|checksum|etag|revision|rev|uuid|guid|build|version|isbn|card|phone|order|invoice|page)"
PLACEHOLDER = r"(?:your|example|sample|changeme|placeholder|dummy|x{6,}|0{8,}|1234567|abcdef)"
PREFIX = r"^(?:AKIA[0-9A-Z]{12,}|gh[pousr]_|xox[abps]-|sk_live_|AIza|glpat-)"

FEATURES = [
    "f_length", "f_distinct", "f_digits", "f_upper", "f_lower", "f_symbols", "f_turns", "f_pairs", "f_hex", "f_number",
    "f_dictionary", "f_prefix", "f_placeholder", "f_credential", "f_assigned", "f_quoted", "f_harmless", "f_path_config", "f_path_test",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """id, word_no, value, before, after, path, key (of the text and path): one row per candidate."""
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(path, F.lit("")).alias("path"))
    rows = rows.withColumn("key", F.xxhash64("text", "path"))
    words = F.split("text", r"[\x20\x09-\x0D]+")
    found = F.filter(
        F.transform(
            "words",
            lambda w, i: F.when(
                w.rlike(CANDIDATE),
                F.struct(i.alias("word_no"), w.alias("word"), F.concat_ws(" ", F.get("words", i - 3), F.get("words", i - 2), F.get("words", i - 1)).alias("lead"), F.get("words", i + 1).alias("next")),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    # most texts hold none and are not split
    rows = rows.where(F.col("text").rlike(CANDIDATE)).withColumn("words", words)
    rows = rows.select("id", "path", "key", F.explode(found).alias("x")).select("id", "path", "key", "x.*")
    # The pieces between the joined runs are one more than these.  What comes from outside the word goes
    # to its first and last piece alone, so that a word of many runs does not carry it along with each.
    joined, pieces = F.regexp_extract_all("word", F.lit(JOINED), F.lit(0)), F.split("word", JOINED)
    n = F.size(joined)
    first = F.array(F.concat_ws(" ", F.nullif("lead", F.lit("")), F.element_at(pieces, 1)))
    last = F.array(F.concat_ws(" ", F.element_at(pieces, -1), "next"))
    parts = F.arrays_zip(joined.alias("joined"), F.concat(F.array(F.lit("")), F.slice(joined, 1, n - 1)).alias("prior"), F.concat(first, F.slice(pieces, 2, n - 1)).alias("left"), F.concat(F.slice(pieces, 2, n - 1), last).alias("after"))
    rows = rows.select("id", "path", "key", "word_no", F.explode(parts).alias("x")).select("id", "path", "key", "word_no", "x.*")
    values, before = F.regexp_extract_all("joined", F.lit(CANDIDATE), F.lit(0)), F.concat(F.right("prior", F.lit(NEAR)), "left")
    places = F.arrays_zip(values.alias("value"), F.concat(F.array(before), F.array_repeat(F.right(before, F.lit(NEAR)), F.size(values) - 1)).alias("before"))
    return rows.select("id", "path", "key", "word_no", F.left("after", F.lit(NEAR)).alias("after"), F.explode(places).alias("x")).select("id", "word_no", "x.value", "x.before", "after", "path", "key")


def features(rows: DataFrame) -> DataFrame:
    """Adds the FEATURES columns to value, before, after, path."""
    value, low, n = F.col("value"), F.lower("value"), F.length("value")
    before = F.lower("before")
    count = lambda pattern, of=value: F.regexp_count(of, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    assigned = r"[=:]\s*[\"'`]?\s*$"
    return rows.withColumns(
        {
            "f_length": n.cast("double"),
            "f_distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(64)),
            "f_digits": count("[0-9]") / n,
            "f_upper": count("[A-Z]") / n,
            "f_lower": count("[a-z]") / n,
            "f_symbols": count(r"[+/_\-]") / n,
            "f_turns": count(r"(?<=[0-9])(?=[^0-9])|(?<=[A-Z])(?=[^A-Z])|(?<=[a-z])(?=[^a-z])|(?<=[+/_\-])(?=[^+/_\-])") / n,
            "f_pairs": count("(?=th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|ed|is|it|al|ar|st|to|nt|de|le|un|ch)", low) / n,
            "f_hex": flag(value.rlike("^[0-9a-f]+$")),
            "f_number": flag(value.rlike(r"^[0-9\-+/]+$")),
            "f_dictionary": F.lit(1.0) - F.length(F.regexp_replace(low, DICTIONARY, "")) / n,
            "f_prefix": flag(value.rlike(PREFIX)),
            "f_placeholder": flag(low.rlike(PLACEHOLDER)),
            "f_credential": flag(before.rlike(CREDENTIAL)),
            "f_assigned": flag(before.rlike(assigned)),
            "f_quoted": flag(before.rlike("[\"'`]$")),
            "f_harmless": flag(before.rlike(r"\b" + HARMLESS + r"\b")),
            "f_path_config": flag(F.lower("path").rlike(r"\.(?:env|ya?ml|ini|cfg|conf|properties|toml|json)$")),
            "f_path_test": flag(F.lower("path").rlike("test|example|sample|fixture|docs?/")),
        }
    )


def labelled_findings(found: DataFrame, sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """value, before, after, path, label: at most 13 rows for each of ``sample`` candidates and of 64 bare places."""
    bare = found.sparkSession.range(64).select((-F.col("id") - 1).alias("id"), F.lit("").alias("path"), F.lit(0).alias("word_no"), F.lit("").alias("value"), F.lit("text before it").alias("before"), F.lit("and after").alias("after"))
    places = found.select("id", "path", "word_no", "value", "before", "after").orderBy(F.xxhash64(F.lit(seed), "id", "word_no", "value"), "id", "word_no", "before").limit(sample).unionByName(bare)
    key = F.concat_ws("-", F.lit(seed), F.coalesce("id", F.lit(0)), "word_no", "value")
    places = places.withColumns({"h": F.sha2(key, 256), "r": F.xxhash64(key), "plain": F.regexp_replace("before", "[=:\"'`]|(?i)" + CREDENTIAL, "")})
    places = places.withColumn("b", F.translate(F.base64(F.unhex("h")), "+/=", "xyz"))
    pick = lambda words, shift: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.shiftright("r", shift), F.lit(len(words))) + 1).cast("int"))
    named = F.concat("plain", F.lit(" "), pick(("token", "secret", "password", "api_key", "access_key", "auth_token"), 3), pick((' = "', "=", ": ", ' = "', "='", ": \""), 9))
    harmless = F.concat("plain", F.lit(" "), pick(("commit ", "sha1: ", "sha256 = ", "checksum: ", "etag \"", "revision ", "digest=", "uuid "), 5))
    digits = F.rpad(F.regexp_replace("h", "[^0-9]", ""), 16, "7")
    example = lambda value, before, label: F.struct(value.alias("value"), before.alias("before"), F.lit(label).cast("double").alias("label"))
    sub = F.substring
    clear = F.when(F.col("value").rlike("^[0-9]+$"), F.lit(0.0)).when(F.lower("before").rlike(CREDENTIAL + r"\W{0,4}$") & F.col("value").rlike("[a-zA-Z]") & ~F.lower("value").rlike(PLACEHOLDER) & (F.size(F.array_distinct(F.split("value", ""))) >= 10), F.lit(1.0))
    cases = [
        example(sub("h", 1, 40), named, 1),
        example(sub("h", 3, 32), named, 1),
        example(sub("b", 1, 32), named, 1),
        example(F.concat(F.lit("AKIA"), F.upper(sub("h", 1, 16))), F.col("plain"), 1),
        example(F.concat(F.lit("ghp_"), sub("b", 1, 36)), F.col("plain"), 1),
        example(sub("h", 1, 40), harmless, 0),
        example(F.col("h"), harmless, 0),
        example(sub(digits, 1, 16), F.col("plain"), 0),
        example(sub(digits, 1, 16), harmless, 0),
        example(F.concat(pick(("your_api_key_here_", "example_token_value_", "changeme_secret_", "xxxxxxxxxxxxxxxx"), 7), sub(digits, 1, 3)), named, 0),
        example(F.concat(F.lit("release-notes-"), sub(digits, 1, 4), F.lit("/page-index-"), sub(digits, 5, 2)), F.col("plain"), 0),
        example(F.concat_ws("-", sub("h", 1, 8), sub("h", 9, 4), sub("h", 13, 4), sub("h", 17, 4), sub("h", 21, 12)), harmless, 0),
        F.struct(F.col("value"), F.col("before"), clear.alias("label")),
    ]
    rows = places.select("id", "word_no", "after", "path", F.posexplode(F.array(*cases)).alias("case", "x"))
    return rows.select("id", "word_no", "case", "x.value", "x.before", "after", "path", "x.label").where("label is not null and length(value) >= 16")


def train(labelled: DataFrame, seed: int = 11):
    """A forest fitted to labelled findings (value, before, after, path, label), which are few by contract."""
    rows = written(features(labelled).select(*FEATURES, "label").coalesce(1).sortWithinPartitions(*FEATURES, "label"), "secrets-labelled")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=32, seed=seed, labelCol="label", featuresCol="features")
    return forest.fit(rows.select("features", "label"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", labelled: DataFrame | None = None, threshold: float = 0.5, keyed: bool = False) -> DataFrame:
    """id, word_no, value, before, score, secret: every candidate with the forest's verdict.  ``keyed``
    adds ``key``, a hash of the row's text and path."""
    found = written(candidates(docs, id_col, text_col, path_col), "secrets-candidates")
    model = train(labelled_findings(found) if labelled is None else labelled)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(found))
    rows = model.transform(rows).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return rows.select("id", "word_no", "value", "before", "score", (F.col("score") >= threshold).alias("secret"), *(["key"] if keyed else []))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", mask: str = MASK) -> DataFrame:
    """The documents, all columns, with every found secret masked in its text, longer ones first, so that a
    secret that holds another is masked whole.

    Rows are told apart by their text and path, not by their id: null and repeated ids are safe, and
    copies are judged once.  A null text stays null; an empty table gives an empty result; columns
    may have any names.  The secrets of one text are held together, never those of several."""
    found = scan_secrets(docs, id_col, text_col, path_col, keyed=True).where("secret")
    longest = F.transform(F.array_sort(F.collect_set(F.struct((-F.length("value")).alias("n"), "value"))), lambda x: x["value"])
    found = written(found.groupBy(F.col("key").alias("of")).agg(longest.alias("secrets")), "secrets-found")
    rows, name = numbered(docs)
    text, path = F.col(name[text_col]).cast("string"), F.col(name[path_col]).cast("string") if path_col else F.lit("")
    key = F.xxhash64(text, F.coalesce(path, F.lit("")))
    joined = rows.withColumn("_key", key).join(side(found, 100_000), F.col("_key") == F.col("of"), "left")
    masked = F.aggregate(F.coalesce("secrets", F.array().cast("array<string>")), text, lambda t, s: F.replace(t, s, F.lit(mask)))
    return joined.withColumn(name[text_col], masked).select(*rows.columns).toDF(*docs.columns)
