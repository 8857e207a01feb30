"""Operator 6 [native]: personal data by candidate gradient boosting.

High-recall generators propose overlapping spans: the four base patterns (email, ip, card, phone),
whose valid matches always stay, and two loose patterns (spelled-out or spaced
addresses; any run of digits and separators).  Boosted trees (Spark ML) score the
loose candidates by format and context.  They are fitted on loose candidates whose label
is known: those of ``LABELLED``, a table of written examples, and those of
all documents, where a valid email or phone rewritten into a loose form
(``rewritten``) is positive, and a number that fails its kind's rule or stands inside a word
is negative.  The trees are compiled to one SQL expression, a threshold for each
kind is calibrated for precision on the held-out half of these candidates, and loose
candidates above it are added where they overlap no base span.

Everything runs as DataFrame expressions: ``split`` gives the text between the
matches and ``regexp_extract_all`` the matches, so running sums of their
lengths give positions in code points.  Only the matches are shuffled, not the
texts.  The patterns start only where a run starts (or the previous match
ended, ``\\G``), which gives the same leftmost matches in linear time.

Defined cases: null text is empty; every row of ``docs`` gives one row, also
with null or repeated ids; an empty table gives no rows and a model that adds no
spans; numbers of 14 digits or more and dotted quads have no positive label, so cards and
addresses of hosts are only found by their base pattern.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.column import Column

from callsmith.llm.common import reliable, text_hash

KINDS = ["email", "ip", "card", "phone"]
CONTEXT = 24  # characters kept on either side of a candidate
FIT_PARTITIONS = 4  # of a small table that the trees are fitted on
FIT_ROWS = 200_000  # in a partition of a larger one

_LOCAL = "[A-Za-z0-9._%+-]"
# kind, pattern, what a text must hold for a match (a cheap test first).  Repeated groups are
# possessive: nothing follows them, so they match the same, and Java does not recurse for each round.
BASE = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]{3}|[0-9][\x20-][0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
LOOSE = {
    "address": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?@\x20?|\x20?[\[(]at[\])]\x20?)"
                r"[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}+)++",
                r"@|[\[(]at[\])]"),
    "number": (r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+", r"[0-9]{3}"),
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether at most 19 digits pass the check sum."""
    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), 1, 19).substr(i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0),
                        lambda acc, i: acc + value(i))
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    n = F.length(_digits(match))
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", match.rlike(rf"\A{part}(?:\.{part}){{3}}\z"))
            .when(kind == "card", F.when((n >= 14) & (n <= 19), _luhn(_digits(match)))
                  .otherwise(F.lit(False)))
            .when(kind == "phone", (n >= 10) & (n <= 15))
            .otherwise(F.lit(False)))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate (one with a null ``match`` for a document without): row,
    doc_id, text_hash, made (generator), match, start, end, left, right."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = {**BASE, **LOOSE}
    base = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").alias("doc_id"), text.alias("t"))
    for name, (pattern, needs) in made.items():
        near = F.col("t").contains("@") if needs == "@" else F.col("t").rlike(needs)
        base = base.withColumn(f"m_{name}", F.when(near, F.regexp_extract_all(
            F.col("t"), F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    for name, (pattern, _) in made.items():
        base = base.withColumn(f"g_{name}", F.when(F.size(f"m_{name}") > 0, F.split(
            F.col("t"), pattern, -1)).otherwise(F.array().cast("array<string>")))
    # Each match with the text before it; one more entry holds the text after the last.
    def entries(n: str) -> Column:
        return F.transform(F.arrays_zip(f"g_{n}", f"m_{n}"), lambda x, i: F.struct(
            F.lit(n).alias("made"), i.alias("i"), x[f"m_{n}"].alias("match"),
            F.length(x[f"g_{n}"]).alias("gap"),
            F.left(x[f"g_{n}"], F.lit(CONTEXT)).alias("head"),
            F.right(x[f"g_{n}"], F.lit(CONTEXT)).alias("left")))

    rows = base.select("row", "doc_id", text_hash(F.col("t")).alias("text_hash"),
                       F.explode_outer(F.concat(*[entries(n) for n in made])).alias("c")).select(
        "row", "doc_id", "text_hash", "c.*")
    here = Window.partitionBy("row", "made").orderBy("i")
    size = F.length(F.coalesce("match", F.lit("")))
    end = F.sum(F.col("gap") + size).over(here.rowsBetween(Window.unboundedPreceding, 0))
    found = rows.repartition("row").select(
        "*", end.cast("bigint").alias("end"), F.lead("head").over(here).alias("right"))
    # The entry after a generator's last match is no candidate; a document without
    # any keeps its one empty row.
    return found.filter("match is not null or made is null").select(
        "row", "doc_id", "text_hash", "made", "match",
        (F.col("end") - F.length("match")).alias("start"), "end", "left", "right")


FEATURES = ["size", "digits", "letters", "spaces", "dashes", "dots", "brackets", "plus", "at",
            "runs", "longest", "left_word", "right_word", "left_mark", "said_mail", "said_call",
            "said_card", "said_net"]


def featured(rows: DataFrame) -> DataFrame:
    """Format and context features (doubles), and the kind a candidate would be."""
    m, left, right = F.col("match"), F.coalesce("left", F.lit("")), F.coalesce("right", F.lit(""))

    def count(pattern: str) -> Column:
        return F.length(F.regexp_replace(m, f"[^{pattern}]", ""))

    said = F.lower(left)
    columns = {
        "size": F.length(m), "digits": count("0-9"), "letters": count("A-Za-z"),
        "spaces": count(r"\x20"), "dashes": count("-"), "dots": count("."),
        "brackets": count(r"()\[\]"), "plus": m.startswith("+"), "at": m.contains("@"),
        "runs": F.size(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))),
        "longest": F.array_max(F.transform(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)),
                                           F.length)),
        "left_word": left.rlike(r"[\p{L}0-9_]\z"), "right_word": right.rlike(r"\A[\p{L}0-9_]"),
        "left_mark": left.rlike("[\"'=:#/$]\\z"),
        "said_mail": said.rlike("mail|contact|write"), "said_call": said.rlike("tel|phone|call|fon|fax"),
        "said_card": said.rlike("card|visa|karte|carte|tarjeta"),
        "said_net": said.rlike("ip|host|server|addr"),
    }
    kind = (F.when(F.col("made").isin(KINDS), F.col("made"))
            .when(F.col("made") == "address", "email")
            .when(m.rlike(r"\A[0-9]+(\.[0-9]+){3}\z"), "ip")
            .when(count("0-9") >= 14, "card").otherwise("phone"))
    return rows.select("*", kind.alias("kind"), *[
        F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{n}") for n, c in columns.items()])


# Written examples: # is a digit, ~ a word, {a|b} a choice.  Every loose candidate of a text has its label.
_CALL = "{call|Call|phone|tel.|Tel:|telephone|fax|Telefon|call me on|my phone is}"
_WRITE = "{|~ ~ |~, ~ |contact |write to |e-mail: |mail |~ ~ ~. |(|~: }"
_AFTER = "{|.|, ~ ~| ~ ~ ~| or ~|; ~}"
LABELLED = {
    1: [f"{_WRITE}~{{|.~|##|_~}}{{ (at) | [at] |(at)|[at]}}~{{|-~|#}}{{ (dot) | [dot] |(dot)|.}}"
        f"{{com|org|net|de|fr|example.com|co.uk}}{_AFTER}",
        f"{_WRITE}~{{|.~|##|_~}} @ ~{{|-~|#}}.{{com|org|net|de|fr|example.com|co.uk}}{_AFTER}",
        f"{_WRITE}~{{|.~|##|_~}}@~{{|-~|#}}{{ (dot) | [dot] |(dot)}}{{com|org|net|de|fr}}{_AFTER}",
        f"{{~ ~ |~, |{_CALL} }}({{##|###}}){{ |}}###{{-| |.}}####{_AFTER}",
        f"{{~ ~ |~, |{_CALL} }}{{|1-}}###-###-####{_AFTER}",
        f"{_CALL} {{###.###.####|### ### ####|0## #### ####|0### ######|0###-#######|##########|00## ### #######}}{_AFTER}",
        f"{_CALL} {{(0##) #######|0##-### ## ##|## ## ## ## ##|###-####}}{_AFTER}"],
    0: ["~ ~ {#|##|###}{ @ |@ }{#.##|##.##|###.#} {each|~ ~|per ~}",
        "~ {~|~#} {@|(at)|[at]} {#.#|##.##|#.##.#} ~",
        "~ ~ @~.~ ~",
        "~ ~ {19|20}##-{0#|1#}-{0#|1#|2#}{| ##| ####} ~",
        "~ ~ {0#|1#|2#}.{0#|1#}.{19|20}## ~",
        "~ ~ {|between |from |pages |in }{19|20}##{-| - | }{19|20}##{,| ~} ~",
        "~ {# ### ###|## ### ###|### ### ###|#.###.###|##.###.###} {~|people|euro} ~",
        "~ {ISBN |isbn: |}978-#-##-######-# ~",
        "~ {order|Order no.|invoice|ticket|ref.|item|part|page|id|version|~|~ ~} {#######|########|#########|##########|####-####|######-####|###.####.##|#.#.#####} ~",
        "~ = {\"|'|}{#######|#########|##########|###########}{\"|'|} ~",
        "{~|a|f}{#######|########|##########|####-####} ~",
        "~ = \"{a|~b|c#d}{#######|#########|##########}{e|c#f} ~",
        "~ = \"{#######|#########|##########}{e|c#f|b~} ~",
        "~ ~ ##.#### {|-}##.#### ~",
        "~ ~ # # # # # # # {# # #|#} ~", "~ ## ## ## {##|## ##} ~", "~ ### ### ### {###|### ###} ~",
        "~ {################|#### #### #### ####|##################|### ### ### ### ### ###} ~",
        "~ {###.###.###.###|9##.#.#.#|##.#.#####.#} ~",
        "~ {$|€|USD }{#######|# ### ###.##|########.##} ~"],
}
_SYLLABLES = ["an", "be", "cor", "da", "el", "fi", "gra", "ho", "in", "ka", "lo", "mer", "no", "ó", "per", "ri",
              "sta", "tu", "ve", "wil"]


def labelled(each: int = 60) -> list[tuple[int, str]]:
    """(label, text) rows: ``each`` fillings of every example, always the same."""
    rng = random.Random(6)

    def word() -> str:
        return "".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4)))

    def choose(example: str) -> str:
        while "{" in example:  # the innermost choice first
            end = example.index("}")
            start = example.rindex("{", 0, end)
            example = example[:start] + rng.choice(example[start + 1:end].split("|")) + example[end + 1:]
        return "".join(str(rng.randint(0, 9)) if c == "#" else word() if c == "~" else c for c in example)

    return [(label, choose(e)) for label, examples in LABELLED.items() for e in examples for _ in range(each)]


def rewritten(rows: DataFrame) -> DataFrame:
    """Valid base emails and phones (rows of ``candidates``) as loose candidates in the same
    context, without what gives them away: spelled-out or spaced addresses, and
    phones without plus and country number that keep a bracket or separator."""
    form = F.pmod(F.xxhash64("text_hash", "start"), F.lit(3))
    name, host = F.split("match", "@")[0], F.split("match", "@")[1]
    address = (F.when(form == 0, F.concat(name, F.lit(" (at) "), F.replace(host, F.lit("."), F.lit(" (dot) "))))
               .when(form == 1, F.concat(name, F.lit("[at]"), F.replace(host, F.lit("."), F.lit("[dot]"))))
               .otherwise(F.concat(name, F.lit(" @ "), host)))
    local = F.regexp_replace("match", r"\A\+[0-9]{1,3}[\x20.-]?", "")
    keeps = (F.length(_digits(local)) >= 10) & local.rlike(r"[(]|[0-9]-[0-9]")
    valid = rows.filter(_valid(F.col("made"), F.col("match")))
    return valid.filter("made = 'email'").withColumn("match", address).withColumn("made", F.lit("address")).unionByName(
        valid.filter("made = 'phone'").filter(keeps).withColumn("match", local).withColumn("made", F.lit("number")))


@dataclass
class Model:
    """Boosted trees as one SQL expression over the features, and a threshold for each kind."""
    score: Column | None
    thresholds: dict[str, float]


def _tree(node) -> Column:
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(F.col(f"f_{FEATURES[split.featureIndex()]}") <= float(split.threshold()),
                  _tree(node.leftChild())).otherwise(_tree(node.rightChild()))


def train(docs: DataFrame, precision: float = 0.98, rounds: int = 10, depth: int = 3) -> Model:
    """Fit and calibrate on all documents; equal texts count once.

    Only loose candidates are used, with the labels of ``LABELLED``, of ``rewritten`` and of the rules."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    if docs.isEmpty():
        return Model(None, {})
    # The candidates of equal texts are equal: only they are shuffled, not the texts.
    found = reliable(candidates(docs.select("doc_id", "text")).filter("match is not null").dropDuplicates(
        ["text_hash", "made", "start", "match"]))
    written = candidates(docs.sparkSession.createDataFrame(labelled(), "doc_id bigint, text string")).filter(
        F.col("made").isin(*LOOSE)).withColumn("label", F.col("doc_id").cast("double"))
    # Numbers that cannot be what their kind says and overlap no base span.
    numbers = featured(found.filter("made = 'number'"))
    inside = (F.col("f_left_word") > 0) | (F.col("f_right_word") > 0)
    wrong = F.col("kind").isin("card", "ip") & ~_valid(F.col("kind"), F.col("match"))
    spans = found.filter(_valid(F.col("made"), F.col("match"))).select(
        F.col("text_hash").alias("of"), F.col("start").alias("from"), F.col("end").alias("to"))
    refused = numbers.filter(inside | wrong).join(
        spans, (F.col("text_hash") == F.col("of")) & (F.col("from") < F.col("end")) & (F.col("start") < F.col("to")),
        "left_anti").select(*found.columns, F.lit(0.0).alias("label"))
    rows = featured(written.unionByName(rewritten(found).withColumn("label", F.lit(1.0))).unionByName(refused))
    # Each level of a tree is a job over all, so there are no more partitions than the rows need.
    rows = reliable(rows.withColumn("fold", F.pmod(F.col("text_hash"), F.lit(2))).select(
        "kind", "made", "label", "fold", *[f"f_{n}" for n in FEATURES]))
    rows = rows.coalesce(max(FIT_PARTITIONS, rows.count() // FIT_ROWS))
    fit = rows.filter("fold = 0")
    if {r["label"] for r in fit.select("label").distinct().collect()} != {0.0, 1.0}:
        return Model(None, {})
    vectors = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features")
    boosted = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1).fit(
        vectors.transform(fit).select("features", "label"))
    margin = F.lit(0.0)
    for tree, weight in zip(boosted.trees, boosted.treeWeights):
        margin = margin + F.lit(float(weight)) * _tree(tree._call_java("rootNode"))
    score = 1.0 / (1.0 + F.exp(-2.0 * margin))
    # Calibration: the least score from which on the held-out candidates of a kind reach the precision.
    steps = (rows.filter("fold = 1").select("kind", "label", F.floor(score * 100).alias("s"))
             .groupBy("kind", "s").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
             .collect())
    thresholds = {}
    for kind in KINDS:
        good = n = 0
        for r in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["s"]):
            good, n = good + r["good"], n + r["n"]
            if good < precision * n:
                break
            if n >= 20:
                thresholds[kind] = r["s"] / 100
    return Model(score, thresholds)


def find_pii(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: row, doc_id, text_hash, base and spans: sorted arrays of
    (start, kind_no, end, kind); end exclusive, code points."""
    rows = candidates(docs)
    is_base = F.coalesce(_valid(F.col("made"), F.col("match")), F.lit(False))
    if model.score is None or not model.thresholds:
        rows = rows.withColumn("kind", F.col("made")).withColumn("is_base", is_base)
        added = F.lit(False)
    else:
        rows = featured(rows).withColumn("is_base", is_base)
        least = F.lit(2.0)
        for kind, t in model.thresholds.items():
            least = F.when(F.col("kind") == kind, F.lit(t)).otherwise(least)
        before = Window.partitionBy("row").orderBy("start", "end")
        over_end = F.max(F.when(F.col("is_base"), F.col("end"))).over(
            before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        over_start = F.min(F.when(F.col("is_base"), F.col("start"))).over(
            before.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        rows = rows.select("*", (F.col("made").isin(*LOOSE) & (model.score >= least)).alias("scored"),
                           over_end.alias("over_end"), over_start.alias("over_start"))
        added = (F.col("scored") & (F.coalesce("over_end", F.lit(-1)) <= F.col("start"))
                 & (F.coalesce("over_start", F.col("end")) >= F.col("end")))
    no = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(F.col("start").alias("start"), no.alias("kind_no"), F.col("end").alias("end"),
                    F.col("kind").alias("kind"))
    return rows.groupBy("row", "doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_base"), span))).alias("base"),
        F.array_sort(F.array_distinct(F.collect_list(
            F.when(F.col("is_base") | added, span)))).alias("spans"))


def spans_text(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets.

    Rows are matched by doc_id and text, so repeated ids keep their own spans."""
    found = (find_pii(docs, model).filter(F.size("spans") > 0)
             .select(F.col("doc_id").alias("_pii_id"), F.col("text_hash").alias("_pii_hash"),
                     F.col("spans").alias("_pii_spans"))
             .dropDuplicates(["_pii_id", "_pii_hash"]))
    text = F.col("text").cast("string")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_pii_id"))
                       & (text_hash(docs["text"]) == F.col("_pii_hash")), "left")
    pieces = F.aggregate(
        "_pii_spans", F.struct(F.lit(0).cast("bigint").alias("at"),
                              F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.concat(acc["out"], F.array(F.concat(
                text.substr((acc["at"] + 1).cast("int"), F.greatest(
                    s["start"] - acc["at"], F.lit(0)).cast("int")),
                F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""),
                             text.substr((acc["at"] + 1).cast("int"), F.length(text))))
    new = F.when(F.col("_pii_spans").isNotNull(), pieces).otherwise(text)
    out = joined.withColumn("text", new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_pii_spans").isNotNull(), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(c) for c in docs.columns])
