"""Personal data by weak supervision.

Patterns propose spans. Labelers (format, gazetteer, context words for and
against, neighbouring characters) each vote for, against or not at all.
Expectation-maximisation estimates every labeler's reliability and each span's
probability from the counts of vote patterns alone, and these probabilities
train a logistic classifier on the spans' own features, which decides. Spans
that pass their format's full check are base spans and always stay.

The whole corpus is scanned, but what iterates is one table of vote and
feature counts, whose size is bounded by the number of labelers and features.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmart.llm import spans as sp
from reelmart.llm._common import Shared, text_of

BASE = ["email", "ip", "card", "phone"]
# fixed values: formats of personal data (kind: pattern, string that a match holds)
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", None),
    "card": (r"[0-9](?:[\x20-]?[0-9]){11,}+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", None),
    "local_phone": (r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])", None),
    "hidden_email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}"
                     r"(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}){1,4}+", None),
    "name": (r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20})?(?![a-z])", None),
}
KINDS = list(PATTERNS)
# fixed values: gazetteers
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "it", "nl", "eu"]
FIRST_NAMES = ["Anna", "David", "Elena", "Emma", "Hans", "Jean", "John", "Jose", "Juan", "Julia", "Karl",
               "Laura", "Linda", "Maria", "Marie", "Mary", "Michael", "Paul", "Peter", "Robert", "Sarah", "Thomas"]
FOR_WORDS = r"(?i)\b(?:e-?mail|mail|contact|tel|phone|call|fax|mobile|card|visa|mastercard|iban|account|ssn|" \
            r"social security|address|host|server|ip|dear|name)\b"
AGAINST_WORDS = r"(?i)\b(?:version|release|order|item|isbn|issn|page|chapter|figure|section|ticket|invoice|serial)\b"
LABELERS = ["format", "gazetteer", "context", "against", "edges"]


def passes(match: Column, kind: Column) -> Column:
    """Whether a match passes its format's full check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    parts = F.forall(F.split(match, r"\."), lambda p: F.regexp_like(
        p, F.lit(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$")))
    # an IBAN's check: country and check digits moved to the end, letters as
    # 10 to 35, remainder 97; here by nine-digit steps over at most 68 digits
    moved = F.concat(F.substring(match, 5, 99), F.substring(match, 1, 4))
    spelled = F.array_join(F.transform(F.split(moved, ""), lambda c: F.when(
        F.regexp_like(c, F.lit("[A-Z]")), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    rest = F.aggregate(F.split(spelled, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(
        (acc * 10 + c.cast("int")) % 97))
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", parts)
            .when(kind == "card", F.when(count.between(12, 19), F.call_function("luhn_check", digits)).otherwise(False))
            .when(kind == "phone", count.between(9, 15))
            .when(kind == "ssn", ~F.regexp_like(match, F.lit(r"^(?:000|666|9..)|-00-|-0000$")))
            .when(kind == "iban", rest == 1)
            .otherwise(F.lit(True)))


def votes(cands: DataFrame) -> DataFrame:
    """Adds a column per labeler: 1 for, -1 against, 0 no opinion."""
    kind, match = F.col("kind"), F.col("match")
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    never = F.lit(False)
    last = F.lower(F.element_at(F.split(match, r"[.\])\x20]+"), -1))
    digits = F.regexp_replace(match, "[^0-9]", "")
    email = kind.isin("email", "hidden_email")
    known = F.when(email, vote(last.isin(TOP_DOMAINS), never)) \
        .when(kind == "ip", vote(never, F.regexp_like(match, F.lit(r"^(?:0+|127|255)\.")))) \
        .when(kind == "card", vote(F.regexp_like(digits, F.lit("^(?:4|5[1-5]|3[47]|6011|65|35|2[2-7])")), F.lit(True))) \
        .when(kind == "phone", vote(F.regexp_like(digits, F.lit("^(?:1|2[07]|3[0-469]|4[0-9]|5|6|7|8[1246]|9)")), never)) \
        .when(kind == "name", vote(F.arrays_overlap(F.split(match, "[ .]+"), F.lit(FIRST_NAMES)), never)) \
        .otherwise(0)
    around = F.concat_ws(" ", "before", F.substring("after", 1, 12))
    glued = F.regexp_like("before", F.lit("[A-Za-z0-9]$")) | F.regexp_like("after", F.lit("^[A-Za-z0-9]"))
    return cands.withColumns({
        "format": F.when(F.col("is_base") | F.col("valid"), 1).otherwise(-1),
        "gazetteer": known,
        "context": vote(F.regexp_like(around, F.lit(FOR_WORDS)), never),
        "against": vote(never, F.regexp_like("before", F.lit(AGAINST_WORDS))),
        "edges": vote(never, glued)})


def features(cands: DataFrame) -> list[tuple[str, Column]]:
    """The classifier's 0/1 features of a span."""
    size = F.length("match")
    out = [(f"kind_{k}", F.col("kind") == k) for k in KINDS]
    out += [(f"size_{a}", size.between(a, b)) for a, b in ((1, 9), (10, 14), (15, 19), (20, 99))]
    out += [("valid", F.col("valid")),
            ("glued_before", F.regexp_like("before", F.lit("[A-Za-z0-9]$"))),
            ("glued_after", F.regexp_like("after", F.lit("^[A-Za-z0-9]"))),
            ("word_for", F.regexp_like("before", F.lit(FOR_WORDS))),
            ("word_against", F.regexp_like("before", F.lit(AGAINST_WORDS)))]
    return out


def reliabilities(patterns: DataFrame, rounds: int = 12) -> tuple[dict, DataFrame]:
    """EM over ``kind, <labelers>, n``: parameters, and patterns with ``p``.

    Two classes, labelers independent given the class, one prior per kind, all
    counts smoothed by one. Starts from the majority of votes. Each round is
    one aggregate over the bounded table of patterns.
    """
    total = sum((F.col(x) for x in LABELERS), F.lit(0))
    p = F.when(total > 0, F.lit(0.9)).when(total < 0, F.lit(0.1)).otherwise(F.lit(0.5))
    params: dict = {}
    for _ in range(rounds):
        scored = patterns.withColumn("p", p)
        sums = []
        for y, mass in (("yes", F.col("p") * F.col("n")), ("no", (1 - F.col("p")) * F.col("n"))):
            sums += [F.sum(F.when(F.col("kind") == k, mass)).alias(f"kind|{k}|{y}") for k in KINDS]
            sums += [F.sum(F.when(F.col(x) == v, mass)).alias(f"{x}|{v}|{y}") for x in LABELERS for v in (-1, 0, 1)]
        row = scored.agg(*sums).first().asDict()
        mass = {k: (v or 0.0) + 1.0 for k, v in row.items()}
        params = {}
        for k in KINDS:
            params["kind", k] = math.log(mass[f"kind|{k}|yes"] / mass[f"kind|{k}|no"])
        for x in LABELERS:
            for y in ("yes", "no"):
                whole = sum(mass[f"{x}|{v}|{y}"] for v in (-1, 0, 1))
                for v in (-1, 0, 1):
                    params[x, v, y] = mass[f"{x}|{v}|{y}"] / whole
        odds = F.lit(0.0)
        for k in KINDS:
            odds = odds + F.when(F.col("kind") == k, params["kind", k]).otherwise(0.0)
        for x in LABELERS:
            for v in (-1, 0, 1):
                gain = math.log(params[x, v, "yes"] / params[x, v, "no"])
                odds = odds + F.when(F.col(x) == v, gain).otherwise(0.0)
        p = 1 / (1 + F.exp(-odds))
    return params, patterns.withColumn("p", p)


def train(counted: DataFrame, names: list[str]) -> Column:
    """The probability of a span as a column over its features.

    ``counted``: features, ``p`` and ``n``. Each pattern counts as ``n * p``
    positive and ``n * (1 - p)`` negative examples.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    vec = array_to_vector(F.array(*[F.col(x).cast("double") for x in names]))
    rows = counted.select(vec.alias("features"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("e"))
    model = LogisticRegression(weightCol="weight", maxIter=40, regParam=1e-4, standardization=False).fit(
        rows.select("features", "e.*"))
    odds = F.lit(float(model.intercept))
    for x, w in zip(names, model.coefficients):
        odds = odds + F.when(F.col(x), float(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = 0.5) -> DataFrame:
    """One row per document: ``id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Counts and ``base_sha256`` cover the base spans, ``spans`` all that stay.
    Null texts count as empty; a document without spans has zeros and an empty
    list; a corpus without any candidates trains nothing. Rows that repeat an
    id are documents of their own. An empty table gives no rows.
    """
    shared = Shared(docs.sparkSession, "pii")
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       text_of(text_col).alias("text"))
    cands = shared.table(sp.candidates(rows, "row", F.col("text"), PATTERNS, ["id"]), "candidates")
    at = sp.positions(cands, "row", KINDS).withColumn("valid", passes(F.col("match"), F.col("kind")))
    at = votes(at.withColumn("is_base", F.col("valid") & F.col("kind").isin(BASE)))
    feats = features(at)
    names = [n for n, _ in feats]
    at = shared.table(at.withColumns(dict(feats) | {"valid": F.col("valid")}).drop("before", "after", "match"),
                      "voted")
    counted = shared.table(at.groupBy("kind", *LABELERS, *names).agg(F.count(F.lit(1)).alias("n")), "patterns")
    if counted.isEmpty():
        kept = at.filter("is_base")
    else:
        _, scored = reliabilities(counted)
        kept = at.filter(F.col("is_base") | (train(scored, names) >= threshold))
    out = sp.with_digest(cands.select("id", "row"), sp.digest(kept, "row", BASE, KINDS), "row", BASE)
    return out.drop("row")
