"""Personal data: base forms, and bootstrapped contextual extraction for unseen ones.

Base forms are regular expressions with checks. They seed a graph of tokens and lexical
patterns (the words around an identifier-like token). Rounds of grouping score a pattern by
the share of its tokens that are known identifiers of a kind, and a token by the patterns
it stands in; tokens of high confidence become known for the next round. All of it runs as
DataFrame functions; texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import keyed_text, release, stored

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
MIN_SUPPORT = 3  # distinct known identifiers that a pattern needs
MIN_PATTERN = 0.6  # share of known identifiers among its tokens, with one added to the total
MIN_TOKEN = 0.9  # confidence from which on a token is an identifier

# Each finds the same leftmost matches as the plain form; possessive parts keep long runs of
# letters or digits from being tried again, and numbers too short for a card are passed over.
_FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a pattern may surround: a whole base form with blanks, or a word with a digit or an @
_TOKEN = rf"{_FORMS['phone']}|{_FORMS['card']}|(?<!\S)\S*[0-9@]\S*"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


_BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(text: Column, form: str, context: bool = False) -> Column:
    """``array<struct<start, end, match>>`` of the leftmost matches, in code points.

    The texts between matches and the matches themselves add up to each place. With
    ``context``, ``before`` and ``after`` are the texts around a match. Matches are put
    together in blocks, so that a text with very many of them costs no quadratic copying.
    """
    between = F.split(text, form, -1)
    matches = F.regexp_extract_all(text, F.lit(form), F.lit(0))
    fields = "start:int,end:int,match:string" + (",before:string,after:string" if context else "")
    none = F.array().cast(f"array<struct<{fields}>>")

    def all_of(v: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            match = F.get(v["m"], i)
            start = state["at"] + F.char_length(F.get(v["b"], i))
            end = start + F.char_length(match)
            around = [F.get(v["b"], i).alias("before"), F.get(v["b"], i + 1).alias("after")]
            one = F.struct(
                start.alias("start"), end.alias("end"), match.alias("match"), *around[: 2 * context]
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        def block(state: Column, k: Column) -> Column:
            last = F.least(F.size(v["m"]), (k + 1) * _BLOCK) - 1
            begin = F.struct(state["at"].alias("at"), none.alias("out"))
            return _let(F.aggregate(F.sequence(k * _BLOCK, last), begin, step), lambda d: F.struct(
                d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")
            ))

        blocks = F.array().cast(f"array<array<struct<{fields}>>>")
        n_blocks = F.ceil(F.size(v["m"]) / _BLOCK).cast("int")
        placed = F.aggregate(
            F.sequence(F.lit(0), n_blocks - 1), F.struct(F.lit(0).alias("at"), blocks.alias("out")),
            block, lambda s: F.flatten(s["out"]),
        )
        return F.when(n_blocks > 0, placed).otherwise(none)

    return _let(F.struct(matches.alias("m"), between.alias("b")), all_of)


def _luhn(digits: Column) -> Column:
    """The sum with every second digit from the right doubled divides by ten."""
    n = F.char_length(digits)
    places = F.sequence(F.lit(1), n)

    def value(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.char_length(digits)
    if kind == "ip":
        return F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))
        )
    if kind == "card":
        return n.between(12, 19) & _luhn(digits)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _spans_of(text: Column, kind: str) -> Column:
    def span(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
            s["end"].alias("end"), F.lit(kind).alias("kind"),
        )

    found = F.filter(_placed(text, _FORMS[kind]), lambda s: _valid(kind, s["match"]))
    # most texts hold none: one cheap look first
    sign = {"email": "@", "phone": "+"}.get(kind)
    form = F.lit(_FORMS[kind])
    may = F.contains(text, F.lit(sign)) if sign else F.regexp_like(text, form)
    return F.when(may, F.transform(found, span)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start and then kind."""
    parts = [_spans_of(text, kind) for kind in KINDS]
    return F.array_sort(F.concat(*parts))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )), ",",
    )


def _row_key() -> Column:
    """Equal rows have equal results, so the key need not tell them apart."""
    return F.xxhash64("doc_id", "text")


def token_instances(rows: DataFrame) -> DataFrame:
    """``key, start, end, token, kind, patterns`` of identifier-like tokens.

    ``rows`` has ``key, text, base``. ``kind`` is that of the base span at the token, or null.
    """
    with_tokens = rows.filter(F.regexp_like("text", F.lit("[0-9@]"))).select(
        "key", "base", _placed(F.col("text"), _TOKEN, context=True).alias("tokens"),
    )
    token = F.col("t.match")
    lead = F.char_length(F.regexp_extract(token, r"^[^\p{L}\p{N}+]*", 0))
    core = F.regexp_extract(token, r"(?s)^[^\p{L}\p{N}+]*+(.*[\p{L}\p{N}])", 1)
    start = F.col("t.start") + lead
    clean = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}\s:=#]", ""))
    before, after = clean(F.col("t.before")), clean(F.col("t.after"))
    two = F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1)
    one = F.regexp_extract(before, r"(\S+)\s*$", 1)
    right = F.regexp_extract(after, r"^\s*(\S+)", 1)
    at = F.filter(
        "base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))
    )
    return (
        with_tokens.select("key", "base", F.explode("tokens").alias("t"))
        .withColumns({"start": start, "token": core})
        .withColumns({
            "end": F.col("start") + F.char_length("token"),
            "patterns": F.filter(F.array(
                F.when(two != "", F.xxhash64(F.lit("before"), two)),
                F.when((one != "") & (right != ""), F.xxhash64(F.lit("around"), one, right)),
            ), lambda p: p.isNotNull()),
        })
        .filter(F.char_length("token") >= 5)
        .select(
            "key", "start", "end", F.xxhash64(F.lower("token")).alias("token"),
            F.get(F.transform(at, lambda s: s["rank"]), F.lit(0)).alias("kind"), "patterns",
        )
    )


def bootstrap(instances: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``token, kind`` (rank of the kind) of tokens known after the rounds (runs jobs)."""
    edges = stored(
        instances.select("token", F.explode("patterns").alias("pattern")).distinct(), "pii-edges"
    )
    known = stored(
        instances.filter("kind IS NOT NULL").groupBy("token").agg(F.min("kind").alias("kind")),
        "pii-known",
    )
    for _ in range(rounds):
        labelled = edges.join(known, "token", "left")
        counts = labelled.groupBy("pattern").agg(
            F.count("*").alias("n"),
            *[F.sum((F.col("kind") == r).cast("long")).alias(f"k{r}") for r in range(len(KINDS))],
        )
        best = F.greatest(*[
            F.struct(F.coalesce(F.col(f"k{r}"), F.lit(0)).alias("f"), F.lit(r).alias("kind"))
            for r in range(len(KINDS))
        ])
        good = counts.withColumn("best", best).select(
            "pattern", F.col("best.kind").alias("kind"), F.col("best.f").alias("support"),
            (F.col("best.f") / (F.col("n") + 1)).alias("share"),
        ).filter((F.col("support") >= MIN_SUPPORT) & (F.col("share") >= MIN_PATTERN))
        doubt = F.exp(F.sum(F.log(1 - F.col("share"))))
        new = (
            edges.join(good, "pattern").groupBy("token", "kind").agg((1 - doubt).alias("p"))
            .groupBy("token").agg(F.max(F.struct("p", "kind")).alias("m"))
            .filter(F.col("m.p") >= MIN_TOKEN)
            .join(known, "token", "left_anti").select("token", "m.kind")
        )
        grown = stored(known.unionByName(new), "pii-known")
        release(known)
        known = grown
    release(edges)
    return known


def found_spans(instances: DataFrame, known: DataFrame) -> DataFrame:
    """``key, extra``: spans of known tokens where no base span stands."""
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("known_kind") + 1)
    return (
        instances.filter("kind IS NULL")
        .join(known.select("token", F.col("kind").alias("known_kind")), "token")
        .select("key", F.struct(
            F.col("start").cast("int").alias("start"), F.col("known_kind").cast("int").alias("rank"),
            F.col("end").cast("int").alias("end"), kind.alias("kind"),
        ).alias("s"))
        .groupBy("key").agg(F.array_sort(F.collect_set("s")).cast(_SPAN).alias("extra"))
    )


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, base, spans`` for every input row (runs jobs).

    ``base`` are the spans of the base forms, ``spans`` those and the ones found by context;
    both are arrays of ``start, rank, end, kind`` in code points, end exclusive. Null and
    empty texts have none; an empty table gives none. Repeated rows get equal results and
    count once in the graph. Other columns are not read. The words of one text hold its
    spans, so an array never grows beyond a document.
    """
    rows = keyed_text(docs, id_col, text_col).select(
        _row_key().alias("key"), "doc_id", "text", base_spans(F.col("text")).alias("base")
    )
    instances = stored(token_instances(rows), "pii-instances")
    extra = found_spans(instances, bootstrap(instances))
    none = F.array().cast(_SPAN)
    return rows.select("key", "doc_id", "base").join(extra.hint("shuffle_hash"), "key", "left").select(
        "key", "doc_id", "base",
        F.array_sort(F.concat("base", F.coalesce("extra", none))).alias("spans"),
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with the spans of ``find_spans`` replaced in the text (runs jobs)."""
    found = find_spans(docs, id_col, text_col)
    extra = found.filter(F.size("spans") > F.size("base")).groupBy("key").agg(
        F.any_value("spans").alias("spans")
    )
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("key", _row_key())
    spans = F.coalesce(F.col("spans"), base_spans(F.col("text")))
    clean = F.when(F.col("_row")[text_col].isNotNull(), redact(F.col("text"), spans))
    # as many rows as documents with added spans: never rely on broadcasting them
    return own.join(extra.hint("shuffle_hash"), "key", "left").select(*[
        (clean if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns
    ])


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlaps are one place."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] >= state["at"], F.concat(state["out"], gap, mark))
            .otherwise(state["out"]).alias("out"),
        )

    rest = lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, begin, step, rest))
