"""Secret scan with a random forest that removes false positives. DataFrame operations only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.session import materialise

LABELLED = 20_000  # labelled findings that the forest is trained on, at most
TREES = 40
DEPTH = 8

# Words next to a secret, words next to other long values, formats of issued keys,
# and a small dictionary of what identifiers and placeholders are made of
SECRET_WORDS = "api[_-]?key|access[_-]?key|auth|bearer|client[_-]?secret|credential|passphrase|passwd|password|private[_-]?key|pwd|secret|signing[_-]?key|token"
OTHER_WORDS = "build|checksum|commit|digest|etag|example|guid|hash|id|isbn|md5|page|revision|sample|sha1|sha256|uuid|version"
ISSUED = (
    "(?:A3T[A-Z0-9]|AKIA|ASIA|ABIA|ACCA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|"
    "glpat-[A-Za-z0-9_-]{20,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}|"
    "AIza[A-Za-z0-9_-]{35}|SG\\.[A-Za-z0-9_-]{16,}\\.[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]*"
)
DICTIONARY = (
    "account|admin|april|august|author|build|change|class|client|code|com|config|content|count|data|default|document|"
    "dummy|edit|email|error|example|false|file|foo|form|home|host|html|http|image|index|info|input|item|lib|license|"
    "link|list|local|mail|main|name|net|news|none|note|null|number|org|page|path|placeholder|post|private|project|"
    "public|query|redacted|sample|server|service|site|source|string|style|system|table|temp|test|text|the|time|title|"
    "true|type|update|user|value|version|view|web|word|work|www|xxxx|your"
)
PLACES = "docs?|examples?|fixtures?|mocks?|samples?|specs?|tests?|testdata"

FEATURES = [
    "size", "distinct", "transitions", "syllables", "digits", "uppers", "hex", "coverage",
    "place", "dotted", "assigned", "quoted", "near_secret", "near_other", "issued",
]


# Patterns of one scan through a word. It goes on where the last match ended and never back, so that long words
# take linear time
RUN = r"A-Za-z0-9_+/.~\-"
QUOTES = r"[\\\"'`]*+"
SIGN = r"(?::?={1,3}>?|:(?!//))"
SECRET_NAME = rf"(?=[{RUN}]*?(?i:{SECRET_WORDS}))[{RUN}]++"
ISSUED_PART = rf"(?<![A-Za-z0-9])(?:{ISSUED})(?![A-Za-z0-9])"
VALUES = (
    rf"\G([^{RUN}]*+)(?:"  # 1: what stands before
    # the password of an address (2)
    r"(?<=:)//[^/:@\"'`<>?#]*+:([^/\"'`<>?#]+)@"
    # a secret word (3) with a value in quotes (4) or up to a quote or the next name (5)
    rf"|({SECRET_NAME}){QUOTES}{SIGN}\\*+[\"'`]?+(?!{SECRET_NAME}{QUOTES}{SIGN})(?:"
    r"((?<=\")(?:[^\"\\]|\\[^\"'`])++|(?<=')(?:[^'\\]|\\[^\"'`])++|(?<=`)(?:[^`\\]|\\[^\"'`])++)"
    rf"|(?<![\"'`])((?:(?![&;,|?]{QUOTES}[\w.\-]++{QUOTES}[=:])[^\"'`])++))"
    # an issued key, or a run without one (6)
    rf"|({ISSUED_PART}|(?:(?!{ISSUED_PART})[{RUN}])++(?:={{1,2}}+(?![=>]|{QUOTES}[{RUN}]))?+)"
    # 7: the signs behind, up to the next value or the end of a part
    rf")(?=([^{RUN}&?;,{{}}()|<>\[\]]*+))"
)


def find_candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, position, word, key, finding, before, after, path) of docs(doc_id, text, <path>).

    Candidates are all values of 12 or more characters with letters and digits, values of an issued format, values
    of 6 or more behind a secret word and = or :, of any signs up to the closing quote, white space or the next
    name, passwords of addresses (their key is password), and heads of private keys. A word may
    hold several. `position` is the number of the
    word in the text, from 0; `word` is the part of it around the value, up to the next separator or the end of the next value; `key` is what the value is assigned to;
    `before` and `after` are the neighbouring words. A null text has none.
    """
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    # a cheap test first: only few words go through the patterns
    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.expr("words")[i].rlike(
            rf"[0-9].{{5}}|.{{5}}[0-9]|(?:{ISSUED})|-----BEGIN|//[^/@]*+@|(?i)(?:{SECRET_WORDS})[\w.\-]*+{QUOTES}[=:]"
        )
        | (
            (i >= 2)
            & F.get("words", i - 1).isin("=", ":", ":=", "=>")
            & F.get("words", i - 2).rlike(rf"(?i)(?:{SECRET_WORDS})")
        )
        | ((i >= 1) & F.get("words", i - 1).rlike(rf"(?i)(?:{SECRET_WORDS})[\w.\-]*+{QUOTES}(?:[=:]|=>)$")),
    )

    def around(i: Column) -> Column:
        """A word and its neighbours; a row carries these only, however many words its text has."""

        def at(shift: int) -> Column:
            return F.coalesce(F.get("words", i + shift), F.lit(""))

        return F.struct(
            i.alias("position"), at(0).alias("whole"), at(-1).alias("before"), at(-2).alias("earlier"),
            at(1).alias("after"), at(2).alias("later"),
        )

    located = (
        docs.select(
            "doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), words.alias("words")
        )
        .select("doc_id", "path", F.explode(F.transform(places, around)).alias("found"))
        .select("doc_id", "path", "found.*")
    )
    signs = F.col("before").rlike("^(?:=|:|:=|=>)$")
    assigned = F.when(signs, F.col("earlier")).when(F.col("before").rlike("(?:[=:]|=>)$"), F.col("before"))
    name = F.regexp_extract(F.coalesce(assigned, F.lit("")), rf"(?<![{RUN}])([{RUN}]++)[^{RUN}]*+$", 1)
    # a name in the words before is put in front, so that one pattern finds all names
    scanned = located.withColumn("name", name).withColumn(
        "scanned",
        F.when(F.col("name") != "", F.concat("name", F.lit("="), "whole")).otherwise(F.col("whole")),
    )
    groups = scanned.withColumns(
        {f"g{n}": F.regexp_extract_all("scanned", F.lit(VALUES), F.lit(n)) for n in range(1, 8)}
    )
    zipped = groups.select(
        "doc_id", "position", "path", "before", "after", "later", "name",
        F.posexplode(F.arrays_zip(
            *(f"g{n}" for n in range(1, 8)), F.array_insert("g6", 1, F.lit("")).alias("g8"),
            *(F.slice(f"g{n}", 2, F.greatest(F.size(f"g{n}"), F.lit(1))).alias(f"next{n}") for n in (1, 2, 3, 6)),
        )).alias("nth", "part"),
    ).select("*", "part.*").where(F.col("g1").isNotNull())
    named = F.when(F.col("g3") != "", F.col("g3")).when(F.col("g2") != "", F.lit("password")).otherwise(
        F.when(F.col("g1").rlike(rf"^{QUOTES}{SIGN}{QUOTES}$"), F.col("g8")).otherwise("")
    )
    padded = F.col("g6").endswith("=") & ((F.length("g6") % 4 != 0) | (F.length("g6") < 12))
    run = F.regexp_replace(
        F.when(padded, F.rtrim("g6", F.lit("="))).otherwise(F.col("g6")), r"^[.\-]+(?=[A-Za-z0-9])|\.+$", ""
    )
    value = (
        F.when(F.col("g4") != "", F.col("g4"))
        .when(F.col("g5") != "", F.rtrim("g5", F.lit(",;.)]}>\\")))
        .when(F.col("g2") != "", F.col("g2"))
        .otherwise(run)
    )
    head = F.concat_ws("", "g4", "g5", "g6")
    pem = (head.endswith("-----BEGIN") & F.concat_ws(" ", "after", "later").rlike("PRIVATE|KEY")) | head.rlike(
        r"-----BEGIN[+_][A-Z0-9+_]*PRIVATE"
    )
    begin = F.regexp_extract(head, "-----BEGIN.*", 0)
    part = F.concat(
        F.regexp_replace("g1", r"^.*[&?;,{}()|<>\[\]]", ""),
        F.when(F.col("g3") != "", F.concat("g3", F.lit("="))).otherwise(F.lit("")),
        F.when(F.col("g4") != "", F.concat(F.lit('"'), "g4")).otherwise(F.concat("g5", "g2", "g6")),
        "g7",
        # the next value belongs to the part if nothing ends it in between
        F.when(
            F.col("next1") == F.col("g7"),
            F.concat("next3", F.when(F.col("next2") != "", F.concat(F.lit("//"), "next2")).otherwise(F.lit("")), "next6"),
        ).otherwise(F.lit("")),
    )
    found = zipped.select(
        "doc_id", "position", "path", "before", "after", part.alias("word"),
        F.regexp_replace(named, r"^.*[/+~]|=+$", "").alias("key"),
        F.when(pem, F.when(begin == "-----BEGIN", F.concat_ws(" ", begin, "after", "later")).otherwise(begin))
        .otherwise(value).alias("finding"),
        # the name that was put in front is no value of this word
        ((F.col("nth") == 0) & (F.col("name") != "") & (F.col("g3") == "")).alias("outside"),
        pem.alias("pem"),
    ).where(~F.col("outside"))
    long = (
        (F.length("finding") >= 12)
        & F.col("finding").rlike("[0-9]")
        & F.col("finding").rlike("[A-Za-z]")
    )
    secret = F.col("key").rlike(rf"(?i)(?:{SECRET_WORDS})") & (F.length("finding") >= 6)
    issued = F.col("finding").rlike(f"^(?:{ISSUED})$")
    return found.where(F.col("pem") | long | secret | issued).select(
        "doc_id", "position", "word", "key", "finding", "before", "after", "path"
    )


def with_features(candidates: DataFrame) -> DataFrame:
    """Add the columns of FEATURES, all doubles and never null."""
    value, lower = F.col("finding"), F.lower("finding")
    size = F.greatest(F.length(value), F.lit(1))
    # one sign per class of characters
    classes = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"
    )
    changes = F.regexp_count(
        classes, F.lit(r"(?<=a)[^a]|(?<=A)[^A]|(?<=0)[^0]|(?<=[^aA0])[aA0]")
    )
    syllables = F.regexp_count(lower, F.lit("[aeiou][bcdfghjklmnpqrstvwxyz]"))
    covered = F.length(value) - F.length(F.regexp_replace(lower, f"(?:{DICTIONARY})", ""))
    around = F.concat_ws(" ", "before", "key", "after")
    columns = {
        "size": F.least(F.length(value), F.lit(200)),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "transitions": changes / size,
        "syllables": syllables / size,
        "digits": F.regexp_count(value, F.lit("[0-9]")) / size,
        "uppers": F.regexp_count(value, F.lit("[A-Z]")) / size,
        "hex": value.rlike("^[0-9a-fA-F]+$").cast("int"),
        "coverage": covered / size,
        "place": F.lower("path").rlike(rf"(?:^|[/._-])(?:{PLACES})(?:[/._-]|$)").cast("int"),
        "dotted": F.regexp_count("word", F.lit("[@/.]")) / size,
        "assigned": (F.col("key") != "").cast("int"),
        "quoted": F.col("word").rlike("[\"'`]").cast("int"),
        "near_secret": around.rlike(rf"(?i)(?:^|[^a-z])(?:{SECRET_WORDS})(?:[^a-z]|$)").cast("int"),
        "near_other": around.rlike(rf"(?i)(?:^|[^a-z])(?:{OTHER_WORDS})(?:[^a-z]|$)").cast("int"),
        "issued": value.rlike(f"^(?:{ISSUED})$|^-----BEGIN").cast("int"),
    }
    return candidates.withColumns({k: v.cast("double") for k, v in columns.items()})


def proven() -> Column:
    """1 or 0 where the context of a finding proves what it is, else null.

    1: an issued format, or a mixed value that is assigned to a secret word. 0: parts of e-mail and
    other addresses, file names, versions and times, placeholders and words.
    """
    mixed = (F.col("digits") > 0.15) & (F.col("size") >= 12) & (F.col("coverage") < 0.3)
    secret = (F.col("issued") == 1) | (
        (F.col("near_secret") == 1) & (F.col("assigned") == 1) & mixed
    )
    named = F.col("key").rlike(rf"(?i)(?:{SECRET_WORDS})")
    address = F.when(
        named, F.col("finding").rlike(r"://|^[\w.+\-]+@[\w.\-]+\.[a-z]{2,}$|^[\w.\-]+\.[a-z]{2,4}$|^[0-9.:,;/\-]+$")
    ).otherwise(F.col("word").rlike(r"@|://|^[\w.\-]+\.[a-z]{2,4}[^\w]*$|^[0-9.:,;/\-]+$"))
    filler = (F.col("coverage") >= 0.5) | F.lower("finding").rlike(r"^(.)\1+$|xxxx|\*{3}")
    return F.when(address | filler, 0.0).when(secret, 1.0)


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)


def train_filter(labelled: DataFrame, bound: int = LABELLED) -> RandomForestClassificationModel | None:
    """A forest on at most `bound` labelled findings, chosen by a hash of the finding.

    `labelled` has FEATURES, `doc_id`, `position`, `finding` and `label`. None without both labels.
    """
    sample = materialise(
        labelled.orderBy(F.xxhash64("finding", "doc_id", "position"), "finding", "doc_id", "position")
        .limit(bound)
        .select(*FEATURES, "label"),
        "findings",
    )
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=1, maxMemoryInMB=64, featureSubsetStrategy="sqrt"
    )
    return forest.fit(_assembled(sample).select("features", "label"))


def score_findings(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Add `score` from 0 to 1. Without a model only what its context proves is judged: other
    findings score 0.5."""
    if model is None:
        return found.withColumn("score", F.coalesce(proven(), F.lit(0.5)))
    scored = model.transform(_assembled(found))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", least: float = 0.5
) -> DataFrame:
    """(doc_id, position, finding, key, score, is_secret) of docs(doc_id, text, <path>).

    One row per candidate, with the forest's verdict; `is_secret` is false for what it removes as a false
    positive. `labelled` (doc_id, position, label) holds findings that people judged, with a column `finding`
    where a word has several; without it, findings whose context proves what they are train the forest, of documents
    whose crc32(doc_id) mod 5 is not 0. Null, empty and clean texts have no rows; a repeated
    row has its findings repeated; other columns are ignored.
    """
    found = materialise(with_features(find_candidates(docs, path)), "candidates")
    if labelled is None:
        train = found.withColumn("label", proven()).where(
            F.col("label").isNotNull()
            & (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(1)) != 0)
        )
    else:
        place = [c for c in ("doc_id", "position", "finding") if c in labelled.columns]
        judged = labelled.select(*place, F.col("label").cast("double").alias("label")).where(
            F.col("label").isNotNull()
        )
        train = found.join(judged, place)
    scored = score_findings(found, train_filter(train))
    return scored.select(
        "doc_id", "position", "finding", "key", "score", (F.col("score") >= least).alias("is_secret")
    )
