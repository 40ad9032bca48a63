"""Personal data by candidate gradient boosting, in DataFrame operations throughout.

Generators propose spans: the four base patterns and wider ones (written-out mail addresses,
colon-separated addresses, digit groups in other shapes). Base spans that pass their check
(octets, Luhn, digits) always stay. A wider candidate that overlaps one of them, or that is a base
match again, is dropped before anything is learnt; the others are labelled by evidence of their
own: the address they spell, the prefix of an IPv6 address, Luhn, the words before a phone number.
Boosted trees over the format of a candidate, written plainly, and the text around it learn these
labels from a bounded, documented sample (`SAMPLE` candidates, by a hash); for each kind the
threshold is the lowest score at which at least `PRECISION` of the calibration half's candidates
with evidence are right, where those without tell how many have it by luck (`LUCK` of all
look-alikes: Luhn exactly, taken for the others too). Wider candidates with evidence at or above it are added unless they overlap a
higher score. Candidates without evidence are never added.

n_email, n_ip, n_card and n_phone count the base spans. NULL texts are empty. Where the sample has
one label only all scores are 1; a kind without candidates in the calibration half adds no spans.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratesmith.llm.common import ROW, numbered, text_of
from ratesmith.sources.workspace import staged

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the base spans. A search goes on only where a run of a pattern's first
# characters begins or the last match ended, which finds the same spans without rescanning runs. The
# last groups are possessive: nothing follows them, and a long one is a loop, not a recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# An address with spaces around plain dots is tried last, or the next sentence would belong to it.
WIDER = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)|@) ?[A-Za-z0-9-]{1,63}"
             r"(?:(?:(?: ?(?:\[dot\]|\(dot\)) ?|\.)[A-Za-z0-9-]{2,63}){1,4}|(?: ?\. ?[A-Za-z0-9-]{2,63}){1,4})",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}"
          r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])",
}
# What the evidence of wider candidates reads.
ADDRESS = r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}$"
SPACED_DOT = r" \.|\. "
MAIL_WORDS = r"(?i)(mail|write|contact)[^A-Za-z]*[a-z]{0,3}[: ]*$"
IPV6_PREFIX = r"(?i)^([23][0-9a-f]{3}|f[cd][0-9a-f]{2}|fe[89ab][0-9a-f]|ff[0-9a-f]{2}):"
HALF_PADDED = r"(?i)(^|:)0[0-9a-f]{1,2}(:|$)"
PHONE_WORDS = r"(?i)(tel|phone|call|fax|mobile)[^A-Za-z]*[a-z]{0,3}[: ]*$"
SAMPLE = 20000
PRECISION = 0.95
LUCK = 0.1
BINS = 50
TREES = 10
DEPTH = 3
FEATURES = ("kind_number", "size", "letters", "gaps", "points", "other", "opens", "closes",
            "capital_before", "word_before", "first_digit", "distinct_digits")


def _hits(kind: str, base: bool, pattern: str) -> Column:
    """Matches with the length of the text before each, and some of the text around."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    between = F.split("text", pattern, -1)

    def placed(both: Column) -> Column:
        return F.transform(both["found"], lambda match, i: F.struct(
            F.length(F.get(both["between"], i)).alias("gap"), match.alias("match"),
            F.right(F.get(both["between"], i), F.lit(24)).alias("before"),
            F.left(F.get(both["between"], i + 1), F.lit(8)).alias("after")))

    # a lambda's argument is evaluated once, a column inside a lambda once per match
    both = F.struct(found.alias("found"), between.alias("between"))
    hits = F.get(F.transform(F.array(both), placed), F.lit(0))
    return F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), hits.alias("hits"))


def candidates(documents: DataFrame) -> DataFrame:
    """One row per document with the matches of every generator."""
    generators = F.array(*[_hits(kind, base, patterns[kind])
                           for base, patterns in ((True, BASE), (False, WIDER)) for kind in KINDS])
    worth = F.col("text").rlike("[0-9@]|[\\[(]at[\\])]")
    return documents.select(ROW, "doc_id", text_of().alias("text")).select(
        ROW, "doc_id", F.when(worth, generators).alias("generators"))


def _checked() -> Column:
    """Whether a base match passes its check."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    parts = F.transform(F.split("match", "\\."), lambda part: F.regexp_replace(part, "^0+", ""))
    octets = F.forall(parts, lambda part: (F.length(part) <= 3) & (
        F.coalesce(part.try_cast("int"), F.lit(0)) <= 255))
    places = F.sequence(F.lit(1), F.length(digits))

    def doubled(i):
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    luhn = F.aggregate(F.transform(places, doubled), F.lit(0), lambda a, b: a + b) % 10 == 0
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", octets)
        .when(F.col("kind") == "card", F.when(F.length(digits).between(16, 19), luhn).otherwise(False))
        .otherwise(F.length(digits).between(8, 15))
    )


def _plain() -> Column:
    """A wider match in the form of the base pattern, where there is one."""
    address = F.regexp_replace(
        F.regexp_replace("match", r" ?(\[at\]|\(at\)|@) ?", "@"), r" ?(\[dot\]|\(dot\)|\.) ?", ".")
    return (
        F.when(F.col("base"), F.col("match"))
        .when(F.col("kind") == "email", address)
        .when(F.col("kind") == "card", F.regexp_replace("match", "[ ._/-]{1,2}", " "))
        .otherwise(F.col("match"))
    )


def _evidence() -> Column:
    """Whether a wider match is what it looks like, told without the base pattern."""
    groups = F.size(F.filter(F.split("match", ":"), lambda group: group != ""))
    return (
        F.when(F.col("kind") == "email", F.col("plain").rlike(ADDRESS) & (
            ~F.col("match").rlike(SPACED_DOT) | F.col("before").rlike(MAIL_WORDS)))
        .when(F.col("kind") == "ip", F.col("match").rlike(IPV6_PREFIX) & ~F.col("match").rlike(HALF_PADDED)
              & F.when(F.col("match").contains("::"), groups <= 7).otherwise(groups == 8))
        .when(F.col("kind") == "card", _checked())
        .otherwise(_checked() & (F.col("match").startswith("(") | F.col("before").rlike(PHONE_WORDS)))
    )


def _count(pattern: str) -> Column:
    return (F.length("plain") - F.length(F.regexp_replace("plain", pattern, ""))).cast("double")


def spans(found: DataFrame) -> DataFrame:
    """One row per candidate that can be learnt from: place, checked base span or not, evidence, features."""
    one = found.select(ROW, F.explode("generators").alias("g")).select(
        ROW, "g.kind", "g.base", F.posexplode("g.hits").alias("place", "hit"))
    order = Window.partitionBy(ROW, "kind", "base").orderBy("place")
    size = F.length("match")
    end = F.sum(F.col("gap") + size).over(order)
    flat = one.select(ROW, "kind", "base", "place", "hit.*")
    digits = F.regexp_replace("match", "[^0-9]", "")
    context = "(?i)(mail|write|contact|tel|phone|call|fax|card|visa|pay|ip|host|addr)[^A-Za-z]*[a-z]{0,3}[: ]*$"
    # a base span that begins at or before a candidate's start, or after it, may reach into it
    earlier = F.max(F.when(F.col("checked"), F.col("end"))).over(Window.partitionBy(ROW).orderBy("start"))
    later = F.min(F.when(F.col("checked"), F.col("start"))).over(Window.partitionBy(ROW).orderBy(F.desc("start")))
    covered = F.coalesce(earlier > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False))
    again = F.max("base").over(Window.partitionBy(ROW, "kind", "start", "end"))
    return (
        flat.withColumns({"end": end, "start": end - size})
        .withColumn("checked", F.col("base") & _checked())
        .withColumns({"covered": covered, "again": again})
        .where("base OR NOT (covered OR again)")
        .withColumn("plain", _plain())
        .withColumn("evidence", F.when(F.col("base"), F.col("checked")).otherwise(_evidence()))
        .select(
            ROW, "kind", "start", "end", "base", "checked", "evidence",
            (F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1).cast("double").alias("kind_number"),
            F.length("plain").cast("double").alias("size"),
            _count("[A-Za-z]").alias("letters"), _count("[ _/]").alias("gaps"), _count("[.]").alias("points"),
            _count("[^A-Za-z0-9 ._/]").alias("other"),
            F.col("before").rlike("(^|[\\s(\\[<\"':=,;])$").cast("double").alias("opens"),
            F.col("after").rlike("^($|[\\s)\\]>\"',;.!?])").cast("double").alias("closes"),
            F.col("before").rlike("[A-Z][a-z]* *$").cast("double").alias("capital_before"),
            F.col("before").rlike(context).cast("double").alias("word_before"),
            F.coalesce(F.substring(digits, 1, 1).try_cast("double"), F.lit(-1.0)).alias("first_digit"),
            F.size(F.array_distinct(F.split(digits, ""))).cast("double").alias("distinct_digits"),
        )
    )


def scored(rows: DataFrame) -> DataFrame | None:
    """Candidates with the score of the trees, or None where none has evidence."""
    counts = rows.agg(F.count("*").alias("n"), F.count_if("evidence").alias("yes")).first()
    if counts.yes == 0:
        return None
    share = F.pmod(F.xxhash64(ROW, "start", "end", F.lit(1)), F.lit(1 << 20)) / float(1 << 20)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        rows.withColumn("label", F.col("evidence").cast("double")))
    learnt = vectors.where(_learning() & (share < SAMPLE / counts.n)).select("features", "label")
    columns = (ROW, "kind", "start", "end", "base", "checked", "evidence", "score")
    if learnt.select("label").distinct().count() < 2:
        return rows.withColumn("score", F.lit(1.0)).select(*columns)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(learnt.coalesce(1))
    probability = vector_to_array("probability")
    return model.transform(vectors).withColumn("score", F.get(probability, F.lit(1))).select(*columns)


def _learning() -> Column:
    return F.pmod(F.xxhash64(ROW), F.lit(2)) == 0


def thresholds(rows: DataFrame) -> dict[str, float]:
    """The lowest score per kind with the wanted precision in the calibration half."""
    bins = rows.where(~_learning()).groupBy("kind", F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.count("*").alias("n"), F.count_if("evidence").alias("yes")).collect()
    found = {}
    for kind in KINDS:
        n = yes = 0
        for row in sorted((r for r in bins if r.kind == kind), key=lambda r: -r.bin):
            n, yes = n + row.n, yes + row.yes
            if (n - yes) * LUCK / (1 - LUCK) <= (1 - PRECISION) * yes:
                found[kind] = row.bin / BINS
    return found


def added_spans(rows: DataFrame) -> DataFrame:
    """Wider candidates that evidence and trees select, apart from checked spans and from each other."""
    limits = thresholds(rows)
    limit = F.lit(2.0)
    for kind, value in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    chosen = rows.where(F.col("checked") | (~F.col("base") & F.col("evidence") & (F.col("score") >= limit)))
    by_start = Window.partitionBy(ROW).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.max("end").over(by_start) <= F.col("start"), F.lit(True)).cast("int")
    islands = chosen.withColumn("new", new).withColumn(
        "island", F.sum("new").over(Window.partitionBy(ROW).orderBy("start", "end")))
    island = Window.partitionBy(ROW, "island")
    best = F.row_number().over(island.orderBy(F.col("score").desc(), "start", "end", "kind"))
    return (
        islands.withColumn("has_base", F.max("checked").over(island)).withColumn("best", best)
        .where("NOT has_base AND best = 1").select(ROW, "kind", "start", "end", F.lit(False).alias("checked"))
    )


def find(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts and digest of the base spans, all spans as text."""
    found = staged(candidates(documents), "pii_matches")
    rows = staged(spans(found), "pii_candidates")
    chosen = rows.where("checked").select(ROW, "kind", "start", "end", "checked")
    with_scores = scored(rows)
    if with_scores is not None:
        chosen = chosen.unionByName(added_spans(staged(with_scores, "pii_scores")))
    number = (F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))).alias("number")
    listed = chosen.groupBy(ROW).agg(
        *(F.count_if(F.col("checked") & (F.col("kind") == kind)).alias(f"n_{kind}") for kind in KINDS),
        F.sort_array(F.collect_list(F.struct(number, "start", "end", "kind", "checked"))).alias("all"))

    def text(spans_: Column) -> Column:
        return F.array_join(F.transform(
            spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    everything = F.coalesce("all", F.array().cast("array<struct<number:bigint,start:bigint,end:bigint,kind:string,checked:boolean>>"))
    return found.select(ROW, "doc_id").join(listed, ROW, "left").select(
        "doc_id",
        *(F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(text(F.filter(everything, lambda s: s["checked"])), 256).alias("base_sha256"),
        text(everything).alias("spans"))


def pii_report(docs: DataFrame) -> DataFrame:
    return find(numbered(docs, "doc_id", "text"))
