"""Secret scan: candidates by pattern, false positives removed by a random forest; DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import stored

#: What may be a secret: at least 16 characters of keys, hashes, base64 and the like.
#: A name and ``=`` at its head (``NAME=value``) are not part of it.
CANDIDATE = r"(?!=)(?![A-Za-z_][A-Za-z0-9_-]{0,63}=[A-Za-z0-9+/_-]{16})[A-Za-z0-9+/_=-]{16,}"
#: Characters of the text that are looked at before and after a candidate.
BEFORE, AFTER = 64, 32
#: Pieces of four letters that make up the dictionary, the most frequent of all words.
DICTIONARY, PIECE = 4096, 4
#: Labelled findings of each kind that the forest is fitted on, at most.
TRAINING = 10_000
TREES, DEPTH, SEED = 20, 6, 7
FEATURES = [
    "length", "digits", "uppers", "hex", "distinct", "changes", "vowel_turns", "covered", "in_path", "in_address", "goes_on",
    "assigned", "quoted", "key_word", "hash_word",
]
#: Beginnings of keys that their issuers have fixed.
PREFIXES = r"^(?:AKIA[0-9A-Z]{16}$|ASIA[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_|glpat-|xox[abprs]-|sk_live_|sk-[A-Za-z0-9]{20}|AIza[A-Za-z0-9_-]{35}$)"
#: Words by a candidate that speak for a credential, and for a plain digest or identifier.
KEY_WORDS = r"(?i)(?:key|token|secret|passw|pwd|auth|credential|bearer|private|signature)"
HASH_WORDS = r"(?i)(?:sha\d|md5|checksum|commit|digest|etag|uuid|hash|revision)"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, id, number, gap, candidate, before, after`` of every candidate of every whole text.

    The text is split at the candidates; a candidate's neighbours are the ends of
    the pieces beside it, ``gap`` the length of the piece before it.
    """
    text, pattern = F.col(text_col), F.lit(CANDIDATE)
    gaps = F.transform(F.split(text, CANDIDATE, -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(BEFORE)).alias("end"), F.left(g, F.lit(AFTER)).alias("head")))
    found = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"), gaps.alias("gaps"))
    each = found.where(F.size("found") > 0).withColumn("row", F.monotonically_increasing_id()).select(
        "row", "id", "gaps", F.posexplode("found").alias("number", "candidate")
    )
    before, after = F.col("gaps")[F.col("number")], F.col("gaps")[F.col("number") + 1]
    return each.select("row", "id", "number", before["n"].alias("gap"), "candidate", before["end"].alias("before"), after["head"].alias("after"))


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent four-letter pieces of the words of all texts.

    Words are counted over all rows, folded before the shuffle; pieces are then
    counted over distinct words. What comes to the driver is at most ``size``.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}{4,}"), F.lit(0))).alias("word"))
    counted = words.groupBy("word").count()
    piece = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - (PIECE - 1)), lambda k: F.substring(F.col("word"), k, F.lit(PIECE))))
    pieces = counted.select("count", piece.alias("piece")).groupBy("piece").agg(F.sum("count").alias("n"))
    return sorted(r.piece for r in pieces.orderBy(F.desc("n"), "piece").limit(size).collect())


def with_features(found: DataFrame, pieces: list[str]) -> DataFrame:
    """``FEATURES`` of every candidate, from itself, the dictionary and its neighbours."""
    c, n = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    def flag(column: str, pattern: str) -> Column:
        return F.col(column).rlike(pattern).cast("double")

    joined = F.concat("before", F.left("candidate", F.lit(4)))  # a candidate may itself begin with slashes
    cut = F.transform(F.sequence(F.lit(1), n - (PIECE - 1)), lambda k: F.substring(F.lower(c), k, F.lit(PIECE)))
    known = F.size(F.filter(cut, lambda p: p.isin(pieces))) if pieces else F.lit(0)
    made = {
        "length": n.cast("double"),
        "digits": share("[0-9]"), "uppers": share("[A-Z]"), "hex": flag("candidate", r"^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "changes": share("[a-z](?=[A-Z0-9])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])|[+/_=-](?=[A-Za-z0-9])"),
        "vowel_turns": share("(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"),
        "covered": known / (n - (PIECE - 1)),
        "in_path": joined.rlike(r"[/\\.]\S*$").cast("double"), "in_address": joined.rlike(r"(?:://|www\.|@)\S*$").cast("double"), "goes_on": flag("after", r"^[./\\@:]\w"),
        "assigned": joined.rlike(r"""[=:]\s*["'`]?[^/\s"'`]{4}$""").cast("double"), "quoted": flag("before", r"""["'`]$""") * flag("after", r"""^["'`]"""),
        "key_word": flag("before", KEY_WORDS + r"[^\n]{0,16}$"), "hash_word": flag("before", HASH_WORDS + r"[^\n]{0,16}$"),
    }
    return found.select("row", "id", "number", "gap", F.length("candidate").alias("size"), kind_of().alias("kind"), *[made[f].cast("float").alias(f) for f in FEATURES],
                        F.col("label") if "label" in found.columns else F.lit(None).cast("int").alias("label"))


def kind_of() -> Column:
    """Which of digits, small letters, capitals and signs a candidate holds: 0 to 15."""
    return sum(F.col("candidate").rlike(p).cast("int") * (1 << k) for k, p in enumerate(("[0-9]", "[a-z]", "[A-Z]", "[+/_=-]")))


def rule_label() -> Column:
    """Label of a finding by rule, for texts without labelled findings: 1 if one rule speaks for a secret, 0 on evidence for something else, else null.

    For a secret speak a value with letters and digits that is assigned to a
    credential's name (code, JSON, YAML, ``.env``, headers), one after ``Bearer``
    or the like, a known prefix, and the lines of a private key. For something
    else speak a place in a path or address, a word for digests, and a candidate
    of plain words or of digits and signs only. The inner lines of a key block
    have no label.
    """
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    quoted = before.rlike(KEY_WORDS + r"""\w*["'`]?\s*(?:[=:]|:=|=>)\s*["'`]$""") & after.rlike(r"""^["'`]""")
    bare = before.rlike(KEY_WORDS + r"""\w*["'`]?[ \t]*[=:][ \t]*$""") & (after.rlike(r"^\s") | (after == ""))
    bearer = before.rlike(r"""(?i)\b(?:bearer|basic|token)[ \t]+["'`]?$""") & before.rlike("(?i)authorization|bearer")
    known = c.rlike(PREFIXES)
    key_block = before.rlike(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s*$") | after.rlike(r"^\s*-----END [A-Z ]*PRIVATE")
    joined = F.concat("before", F.left("candidate", F.lit(4)))
    placed = joined.rlike(r"(?:://|www\.|@|[/\\])\S*$")
    digest = before.rlike(HASH_WORDS + r"""\d*["'`]?[\s=:]*["'`]?$""")
    words = ~c.rlike("[0-9+=]") & ~c.rlike("[a-z][A-Z]") | ~c.rlike("[A-Za-z]")
    secret = known | key_block | (mixed & ~digest & (quoted | bare | bearer))
    return F.when(secret, 1).when(placed | digest | words, 0).cast("int")


def probability(featured: DataFrame, training: int = TRAINING) -> DataFrame:
    """``row, id, number, gap, size, probability`` of every finding, by a forest fitted on labelled ones.

    Of each label about ``training`` findings at most are fitted on, picked by a
    hash, and weighed so that the forest sees the labels as often as the data has
    them. A finding of a kind (``kind_of``) that no labelled finding has is
    outside what was learned: its probability is null. With labelled findings of
    one label only, or of none, nothing can be told apart: every finding has
    that label's probability, or 0.5.
    """
    tally = featured.where("label in (0, 1)").groupBy("label", "kind").count().collect()  # 32 rows at most
    counts = {label: sum(r["count"] for r in tally if r.label == label) for label in {r.label for r in tally}}
    seen = F.col("kind").isin(sorted({r.kind for r in tally}))
    if set(counts) != {0, 1}:
        return featured.withColumn("probability", F.lit(float(next(iter(counts), 0.5)))).drop("label", "kind", *FEATURES)
    pick = F.pmod(F.xxhash64("id", "number", *FEATURES), F.lit(1_000_000))
    rates = {label: min(1.0, training / n) for label, n in counts.items()}
    rate = F.when(F.col("label") == 1, rates[1]).otherwise(rates[0])
    sample = featured.where("label in (0, 1)").where(pick < rate * 1_000_000).select(*FEATURES, "label", (1 / rate).alias("weight"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    ordered = assembler.transform(sample.coalesce(1).sortWithinPartitions("label", *FEATURES))  # so that reruns agree
    forest = RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=1.0).fit(ordered)
    scored = forest.transform(assembler.transform(featured))
    return scored.select("row", "id", "number", "gap", "size", F.when(seen, vector_to_array("probability")[1]).alias("probability"))


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: Column | None = None, threshold: float = 0.5, training: int = TRAINING
) -> DataFrame:
    """``id, number, start, length, probability`` of the findings that the forest takes for secrets: those above ``threshold``.

    ``start`` counts characters from 0, ``number`` the candidates of the text.
    ``label`` gives the kind (1 secret, 0 none, null not labelled) of a candidate
    from ``id``, ``number``, ``candidate``, ``before`` and ``after``; by default it
    is ``rule_label``. Null and empty texts have no candidates. Rows with a null
    or repeated id are scanned like others; repeated rows give repeated findings.
    Other columns are not read. No rows: no rows.
    """
    found = candidates(docs, id_col, text_col).withColumn("label", rule_label() if label is None else label)
    featured = stored(with_features(found, dictionary(docs, text_col)), "secret-candidates")
    likely = probability(featured, training).where(F.col("probability") > threshold)
    earlier = Window.partitionBy("row").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # candidates of one text
    starts = featured.select("row", "number", (F.coalesce(F.sum(F.col("gap") + F.col("size")).over(earlier), F.lit(0)) + F.col("gap")).alias("start"))
    return likely.join(starts, ["row", "number"]).select("id", "number", "start", F.col("size").alias("length"), "probability")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``."""
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "number", "start", "length", F.round("probability", 6).alias("probability"))
