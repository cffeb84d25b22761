"""Personal data: candidates proposed by patterns, selected by gradient-boosted trees.

Everything on the rows is built-in expressions. Base spans come from four patterns with checks. Further generators
propose looser, overlapping spans; each candidate gets features of its format and of the text around it, trees score
it, and those above a threshold calibrated per kind are added where no base span is. The trees are fitted by Spark's
gradient boosting on the candidates of all documents, alike ones counted, and unrolled into conditions, so that scoring
needs no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cloudtally.llm.common import cut

#: Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, written so that a failed start is not tried again inside the same run of characters, and
# possessive, so that neither time nor stack grows faster than the text. They match the same spans.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser generators; their spans may overlap each other and the base patterns'.
LOOSE = {
    "email": (r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+"
              r"(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{1,63}+)++",),
    "ip": (r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",),
    "card": (r"(?<![0-9])[0-9]{12,19}(?![0-9])", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    "phone": (r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
              r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
#: Words before a span that name its kind.
CUES = {"email": "mail|contact", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit|debit|account",
        "phone": "tel|phone|call|fax|mobile"}
FEATURES = ("kind", "length", "digits", "groups", "letters", "signs", "plus", "at", "luhn", "octets", "enough", "cue",
            "before_word", "after_word", "before_digit", "after_digit", "spread")
_AROUND = 24
_SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def _found(text: Column, pattern: str) -> Column:
    """All matches of a pattern as (start, end, match, before, after); offsets in code points, end exclusive.

    `before` and `after` are the text around a match, taken from what lies between matches: no offset is looked up in the
    text, which would read it from its beginning each time.
    """
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def add(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        before = F.right(F.concat(so_far["tail"], pair["gap"]), F.lit(_AROUND))
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"), before.alias("before"),
                        pair["after"].alias("after"))
        return F.struct(end.alias("at"), F.right(F.concat(before, pair["match"]), F.lit(_AROUND)).alias("tail"),
                        F.concat(so_far["out"], F.array(span)).alias("out"))
    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(_SPAN).alias("out"))
    n = F.size(match)
    # What follows a match is the next gap, and where that is short the next match.
    after = F.zip_with(F.slice(gaps, 2, n), F.concat(F.slice(match, 2, n), F.array(F.lit(""))), lambda g, m: F.left(
        F.concat(F.left(g, F.lit(2)), F.left(m, F.lit(2))), F.lit(2)))
    pairs = F.zip_with(F.zip_with(F.slice(gaps, 1, n), match, lambda g, m: F.struct(g.alias("gap"), m.alias("match"))), after,
                       lambda p, a: p.withField("after", a))
    return F.when(text.rlike(pattern), F.aggregate(pairs, none, add, lambda x: x["out"])).otherwise(
        F.array().cast(_SPAN))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)
    # No card has more digits; the sum costs the square of their number.
    return F.when(n.between(1, 19), F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0).otherwise(False)


def _octets(match: Column) -> Column:
    """Whether all parts between dots are at most 255; leading zeros do not count."""
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def _holds(kind: str, match: Column) -> Column:
    """The check that a base match must pass."""
    n = F.length(_digits(match))
    return {"email": F.lit(True), "ip": _octets(match), "card": n.between(12, 19) & _luhn(match),
            "phone": n.between(9, 15)}[kind]


def _marked(docs: DataFrame) -> DataFrame:
    """rest, text, and for each kind the base matches and the loose ones; empty where a text has no digit or @."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest"), text.alias("text"))
    mails = F.contains("text", F.lit("@")) | F.col("text").rlike(r"[\[(]at[\])]")
    own = own.select("rest", "text", F.col("text").rlike("[0-9]").alias("numbers"), mails.alias("mails"))
    none = F.array().cast(_SPAN)

    def some(kind: str, pattern: str) -> Column:
        return F.when(F.col("mails" if kind == "email" else "numbers"), _found(F.col("text"), pattern)).otherwise(none)
    return own.select("rest", "text", *[some(k, BASE[k]).alias(f"base_{k}") for k in KINDS],
                      *[F.concat(*[some(k, p) for p in LOOSE[k]]).alias(f"loose_{k}") for k in KINDS])


def _proposed(docs: DataFrame, learning: bool = False) -> DataFrame:
    """rest, text, `matched` and `kept` (base matches, and those that pass their check), and `labelled`, all candidates.

    `rest` holds the other columns of `docs`, so that nothing has to be joined back.

    A base match that passes its check is `ok`, one that fails is not; a loose one is null, but for `learning` not ok within
    a base span of another kind. Loose ones that equal a base match are told by hashed keys, not by comparing all.
    """
    marked = _marked(docs)

    def listed(kind: str, number: int, column: str, ok: Column | None):
        return F.transform(column, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["match"].alias("match"),
            s["before"].alias("before"), s["after"].alias("after"),
            (_holds(kind, s["match"]) if ok is None else ok).alias("ok")))
    base = F.concat(*[listed(k, i, f"base_{k}", None) for i, k in enumerate(KINDS)])
    loose = F.concat(*[listed(k, i, f"loose_{k}", F.lit(None).cast("boolean")) for i, k in enumerate(KINDS)])
    both = marked.select("rest", "text", base.alias("matched"), loose.alias("loose"))
    kept = F.filter("matched", lambda s: s["ok"])
    both = both.select("rest", "text", "matched", "loose", kept.alias("kept"))

    def within(s: Column) -> Column:
        return F.exists("kept", lambda b: (b["kind"] != s["kind"]) & (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    def keys(spans: str) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(
            ":", *[x.cast("string") for x in (s["kind"], s["start"], s["end"], F.length(s["before"]), F.length(s["after"]))],
            F.concat(s["before"], s["after"], s["match"])))

    def parsed(key: Column) -> Column:
        parts = F.split(key, ":", 6)
        kind, start, end, before, after = (parts[k].cast("int") for k in range(5))
        return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"),
                        F.substr(parts[5], before + after + 1, end - start).alias("match"),
                        F.left(parts[5], before).alias("before"), F.substr(parts[5], before + 1, after).alias("after"),
                        F.lit(None).cast("boolean").alias("ok"))
    rest = F.transform(F.array_except(keys("loose"), keys("matched")), parsed)
    if learning:
        rest = F.transform(rest, lambda s: s.withField("ok", F.when(within(s), False)))
    return both.select("rest", "text", "matched", "kept", F.concat("matched", rest).alias("labelled"))


def _candidates(docs: DataFrame) -> DataFrame:
    """rest, text, `base` (start, kind, end), and `tried`: all candidates with features and a weak label."""
    tried = F.transform("labelled", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["ok"].cast("double").alias("label"),
        _features(s["kind"], s["match"], s["before"], s["after"]).alias("f")))
    return _proposed(docs).select("rest", "text", tried.alias("tried"), F.transform(
        "kept", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).alias("base"))


def _features(kind: Column, match: Column, before: Column, after: Column) -> Column:
    """The candidate's FEATURES as an array of doubles."""
    n = F.length(_digits(match))

    def flag(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("double")
    cue = F.coalesce(*[F.when(kind == i, F.lower(before).rlike(CUES[k])) for i, k in enumerate(KINDS)])
    enough = F.coalesce(F.when(kind == 2, n.between(12, 19)), F.when(kind == 3, n.between(9, 15)), F.lit(True))
    return F.array(
        kind.cast("double"), F.length(match).cast("double"), n.cast("double"),
        F.regexp_count(match, F.lit("[0-9]++")).cast("double"), F.regexp_count(match, F.lit("[A-Za-z]")).cast("double"),
        F.regexp_count(match, F.lit("[^A-Za-z0-9]")).cast("double"), flag(match.startswith("+")),
        flag(match.contains("@") | match.rlike(r"[\[(]at[\])]")), flag(_luhn(match)), flag(_octets(match)), flag(enough),
        flag(cue), flag(before.rlike("[A-Za-z0-9]$")), flag(after.rlike("^[A-Za-z0-9]")), flag(before.rlike("[0-9][ .-]?$")),
        flag(after.rlike("^[ .-]?[0-9]")), F.size(F.array_distinct(F.split(_digits(match), ""))).cast("double"))


@dataclass(frozen=True)
class Model:
    """Trees as (weight, nested tuples of feature, threshold, left, right, or a leaf), and a threshold per kind."""

    trees: list[tuple[float, object]]
    thresholds: tuple[float, ...]

    def score(self, features: Column) -> Column:
        def grown(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, cutoff, left, right = node
            return F.when(features[feature] <= cutoff, grown(left)).otherwise(grown(right))
        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + grown(tree) * weight
        return 1 / (1 + F.exp(-2 * total))


def _unrolled(node) -> object:
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return split.featureIndex(), float(split.threshold()), _unrolled(node.leftChild()), _unrolled(node.rightChild())


def _damaged(match: Column) -> Column:
    """Copies of a sound match with its format broken, one digit changed, cut short, or run on."""
    return F.array_compact(F.array(
        F.concat(F.substring(match, 1, 4), F.lit("300"), F.regexp_extract(match, ".{4}(.*)", 1)),
        F.concat(F.regexp_extract(match, "^(.*).$", 1), ((F.substring(match, -1, 1).try_cast("int") + 1) % 10).cast("string")),
        F.substr(match, F.lit(1), (F.length(match) / 2).cast("int")), F.concat(match, F.lit(" 4321987654321987"))))


def _examples(docs: DataFrame) -> DataFrame:
    """`kind`, `label`, `kept_back`, the other FEATURES, and `n`: how many labelled candidates of `docs` are alike in these.

    Labels are what the base checks say, and 0 for damaged copies of sound matches, in the places of the originals. A fifth
    of the documents, by a hash of their id, is kept back. Alike ones are counted before they are shuffled.
    """
    back = (F.pmod(F.xxhash64("rest.doc_id"), F.lit(5)) == 0).alias("kept_back")
    found = _proposed(docs, learning=True).select(
        back, F.explode(F.filter("labelled", lambda s: s["ok"].isNotNull())).alias("s")).select("kept_back", "s.*")
    copies = F.when(F.col("ok"), _damaged(F.col("match"))).otherwise(F.array().cast("array<string>"))
    tries = F.concat(F.array(F.struct(F.col("match"), F.col("ok").alias("ok"), F.lit(False).alias("copy"))),
                     F.transform(copies, lambda m: F.struct(m.alias("match"), F.lit(False).alias("ok"), F.lit(True).alias("copy"))))
    tried = found.select("kept_back", "kind", "before", "after", F.explode(tries).alias("t")).select(
        "kept_back", "kind", "before", "after", "t.*")
    sound = F.coalesce(*[F.when(F.col("kind") == i, (F.regexp_extract("match", f"^(?:{BASE[k]})$", 0) != F.lit("")) & _holds(
        k, F.col("match"))) for i, k in enumerate(KINDS)])
    tried = tried.filter(~F.col("copy") | ~sound)
    shaped = tried.select("kind", F.col("ok").cast("double").alias("label"), "kept_back", _features(
        F.col("kind"), F.col("match"), F.col("before"), F.col("after")).alias("f"))
    own = shaped.select("kind", "label", "kept_back", *[F.col("f")[i].alias(n) for i, n in enumerate(FEATURES) if n != "kind"])
    # Sorted, so that a rerun fits the same rows in the same order.
    return own.groupBy(*own.columns).agg(F.count("*").alias("n")).sortWithinPartitions(*own.columns)


def _drawn(docs: DataFrame, sample_docs: int) -> DataFrame:
    """At most `sample_docs` documents, by a hash of their id and in equal parts from those that match each kind's base pattern."""
    kinds = F.array_compact(F.array(*[F.when(F.col("text").rlike(BASE[k]), i) for i, k in enumerate(KINDS)]))
    matching = docs.filter(F.col("text").rlike("[0-9@]")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.explode(kinds).alias("kind")).filter("doc_id is not null")
    turn = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("doc_id"), "doc_id"))
    some = matching.withColumn("n", turn).filter(F.col("n") <= sample_docs // len(KINDS)).select("doc_id").distinct()
    return docs.join(F.broadcast(some), "doc_id")


def fit(docs: DataFrame, sample_docs: int | None = None, trees: int = 12, depth: int = 4, precision: float = 0.98) -> Model:
    """Fits on the candidates of all documents; with `sample_docs`, on a draw of at most so many.

    Labels are weak: what the base checks say, and damaged copies of sound matches. Candidates alike in label and features
    become one row that weighs as many, so trees and thresholds see each of them, and a kind that is rare keeps its
    own. Four fifths of the documents fit the trees; on the rest (on all, where a kind has no sound match there) the lowest
    threshold of at least `precision` is set for each kind, one half at least, to four decimals; above all scores where there
    is no sound match at all. With labels of one class no candidate is added.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Stored, so that the trees, which read them many times, do not read the documents again.
    every = cut(_examples(docs if sample_docs is None else _drawn(docs, sample_docs)))
    never = Model([], (2.0,) * len(KINDS))
    if every.filter("not kept_back").select("label").distinct().count() < 2:
        return never
    inputs = VectorAssembler(inputCols=["kind_", *FEATURES[1:]], outputCol="features")
    shaped = inputs.transform(every.withColumn("kind_", F.col("kind").cast("double")).withColumn("n", F.col("n").cast("double")))
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=1, labelCol="label", weightCol="n").fit(
        shaped.filter("not kept_back"))
    grown = [(float(w), _unrolled(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)]
    score = Model(grown, ()).score(F.array(F.col("kind").cast("double"), *FEATURES[1:]))
    # The driver gets a row per kind, fold and step of the score, however many scores there are.
    step = F.when(F.col("score") >= 0.5, F.floor(F.col("score") * 10_000) / 10_000).otherwise(0.0)
    scored = every.withColumn("score", score).groupBy("kind", "kept_back", step.alias("score")).agg(
        F.sum(F.col("label") * F.col("n")).alias("sound"), F.sum("n").alias("all")).collect()

    def threshold(kind: int) -> float:
        own = [r for r in scored if r.kind == kind]
        back = [r for r in own if r.kept_back]
        return _threshold(back if any(r.sound for r in back) else own, precision)
    return Model(grown, tuple(map(threshold, range(len(KINDS)))))


def _threshold(rows: list, precision: float) -> float:
    sound = total = 0
    best = 2.0
    for r in sorted(rows, key=lambda r: -r.score):
        sound, total = sound + r.sound, total + r["all"]
        if r.score >= 0.5 and sound and sound / total >= precision:
            best = r.score
    return best


def _selected(docs: DataFrame, model: Model) -> DataFrame:
    """rest, text, base and spans."""
    found = _candidates(docs)
    threshold = F.array(*[F.lit(t) for t in model.thresholds])
    scored = F.transform(F.filter("tried", lambda s: ~F.coalesce(s["label"] == 1, F.lit(False))), lambda s: F.struct(
        (-model.score(s["f"])).alias("low"), (s["start"] - s["end"]).alias("short"), s["start"].alias("start"),
        s["kind"].alias("kind"), s["end"].alias("end")))
    high = F.array_sort(F.filter(scored, lambda s: -s["low"] >= F.element_at(threshold, s["kind"] + 1)))
    found = found.select("rest", "text", "base", high.alias("high"))

    def add(kept: Column, s: Column) -> Column:
        clash = F.exists(kept, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))))
    return found.select("rest", "text", F.array_sort("base").alias("base"),
                        F.array_sort(F.aggregate("high", F.col("base"), add)).alias("spans"))


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `base`, `spans`: arrays of (start, kind number, end) by start, then kind; `spans` has all base spans.

    Candidates at or above their kind's threshold are added, the highest score first, then the longest, unless they
    overlap a base span or one added before. A null text is empty; every row gives one row; extra columns are ignored.
    """
    return _selected(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select(
        "rest.doc_id", "base", "spans")


def listed(spans_: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with every span in `text` replaced by its kind in brackets, and `n_chars`, if any, counted anew.

    Overlapping spans, which base spans of different kinds may be, are replaced as one, named by the first. A null
    text becomes an empty one.
    """
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    rest = [c for c in docs.columns if c != "text"]
    text = F.col("text")

    def swap(so_far: Column, s: Column) -> Column:
        inside = s["start"] < so_far["at"]
        piece = F.concat(so_far["out"], F.substr(text, so_far["at"] + 1, F.greatest(s["start"] - so_far["at"], F.lit(0))),
                         F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(so_far["at"], s["end"]).alias("at"),
                        F.when(inside, so_far["out"]).otherwise(piece).alias("out"))
    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("spans", none, swap, lambda x: F.concat(x["out"], F.substr(text, x["at"] + 1, F.length(text))))
    changed = F.when(F.size("spans") > 0, new).otherwise(F.col("text"))
    count = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    done = _selected(docs, model).select(changed.alias("text"), *[F.col(f"rest.`{c}`").alias(c) for c in rest])
    return done.select(*[count.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
