"""Personal data and the terms that give it away, by information-theoretic sanitisation.

Built-in expressions only. Emails, IP addresses, card and phone numbers are found
by pattern; each value found is a protected entity. Corpus-wide co-occurrence then
estimates what a term of the same text reveals, wherever it stands outside of the
values themselves: of the -log2 P(e) bits that identify entity e, a term t gives log2 P(e|t) / P(e). Terms that give `GENERALISE` of the bits or
more are generalised, from `REMOVE` on removed, in every document that holds e.
Documents with the same text count once, and a pair needs `SUPPORT` texts. Terms
are runs of three or more letters and digits; shorter ones are mostly function words.

Rows are scanned once for patterns and once for the frequencies of the terms in
question; the latter drops all other words by a bit table of fixed size before
anything is shuffled. So does the pairing of entities and terms with terms too rare
or too common to reveal any entity. Only documents with entities take part in the joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.bits import listed
from tamis.llm.scratch import written

# The patterns of each kind. Lookbehind and possessive quantifiers change no
# match, but keep the search linear: a match can only begin where a run of its characters does.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text with a valid match must hold.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
ADDED = ("generalised", "removed")
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalised": "[TERM]", "removed": ""}

SUPPORT, GENERALISE, REMOVE = 3, 0.85, 0.95
PAIRS = 1 << 20
_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _find_all(text: Column, pattern: Column | str, kind: Column | str) -> Column:
    """All matches as spans: the gaps between them, by `split`, give the places in code points."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"))
    empty = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{_SPAN}>)").alias("spans"))

    def take(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["match"]), F.lit(0))
        kind_of = F.lit(kind) if isinstance(kind, str) else kind
        span = F.struct(kind_of.alias("kind"), start.alias("start"), end.alias("end"), pair["match"].alias("value"))
        spans = F.when(pair["match"].isNull(), done["spans"]).otherwise(F.array_append(done["spans"], span))
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(pairs, empty, take)["spans"]


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = lambda x: F.length(F.ltrim(x, F.lit("0"))) <= 3
        small = lambda x: part(x) & (F.coalesce(F.substring(F.ltrim(x, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _valid_span(kind: str) -> Callable[[Column], Column]:
    return lambda s: _valid(kind, s["value"])


def base_spans(text: Column) -> Column:
    """The personal data of a text: spans by kind, then by start; NULL and empty texts have none."""
    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    found = []
    for kind, pattern in KINDS.items():
        hint = text.contains("@") if kind == "email" else text.rlike(_HINTS[kind])
        valid = F.filter(_find_all(text, pattern, kind), _valid_span(kind))
        found.append(F.when(hint, valid).otherwise(none))
    return F.concat(*found)


def _terms(text: Column, spans: Column) -> Column:
    """The different terms of a text outside of its spans."""
    rest = F.when(F.size(spans) == 0, text).otherwise(_replaced(text, spans, lambda kind: F.lit(" ")))
    return F.array_distinct(F.filter(F.split(F.lower(rest), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) >= 3))


def _revealing(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities by class, classes by text, and what the terms of a class reveal.

    A class is all entities with the same texts: the addresses of a list that stands
    in several texts are one. It is known by their number and two hashes of them.
    """
    held = found.where(F.size("spans") > 0).select("text_id", "text", "spans").dropDuplicates(["text_id"])
    values = F.array_distinct(F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), F.lower(s["value"]).alias("value"))))
    held = written(held.select("text_id", values.alias("values"), _terms(F.col("text"), F.col("spans")).alias("terms")), "held")
    entity = held.select("text_id", F.explode("values").alias("e")).select("text_id", "e.*")
    marks = [F.bit_xor(F.xxhash64(F.lit(k), "text_id")).alias(f"mark_{k}") for k in (1, 2)]
    known = entity.groupBy("kind", "value").agg(F.count("*").alias("n_e"), *marks).where(F.col("n_e") >= SUPPORT)
    known = written(known.select("kind", "value", F.struct("n_e", "mark_1", "mark_2").alias("class")), "entities")
    members = written(entity.join(known, ["kind", "value"]).select("text_id", "class").distinct(), "classes")
    n = float(max(1, found.select("text_id").distinct().count()))
    most = float(known.agg(F.max("class.n_e")).first()[0] or 0)

    def share(n_t: str) -> Column:
        """Of the entity's bits, those that a term in n_t texts gives."""
        n_e = F.col("class.n_e")
        bits = -F.log2(n_e / F.lit(n))
        return F.when(bits > 0, F.log2(F.col("n_et") * F.lit(n) / (n_e * F.col(n_t))) / bits).otherwise(0.0)

    # A term is in as many texts at least as in texts with entities, and n_et is n_e at most: most terms are out before pairs are formed.
    bound = 1 + most**GENERALISE * n ** (1 - GENERALISE)
    seen = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_held"))
    seen = written(seen.where(F.col("n_held").between(SUPPORT, bound)), "terms")
    # Pairs are counted before they move; only the terms' frequencies are joined by term, to one row per pair.
    pairs = _paired(held, members, seen).groupBy("class", "term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= SUPPORT)
    pairs = pairs.join(seen, "term")
    pairs = written(pairs.where(share("n_held") >= GENERALISE).drop("n_held"), "pairs")
    words = found.select("text_id", F.explode(_terms(F.col("text"), F.col("spans"))).alias("term"))
    words = words.where(listed(F.col("term"), pairs, "term")).distinct()
    scored = pairs.join(words.groupBy("term").agg(F.count("*").alias("n_t")), "term")
    return known, members, scored.select("class", "term", share("n_t").alias("share")).where(F.col("share") >= GENERALISE)


def _paired(held: DataFrame, members: DataFrame, seen: DataFrame) -> DataFrame:
    """Each class of a text with each of its terms that may be in `seen`.

    The terms of a text with more than `PAIRS` pairs are dealt to slices, so no task has to form all of them.
    """
    crowds = members.groupBy("text_id").agg(F.count("*").alias("n"))
    slices = F.greatest(F.lit(1), F.least(F.size("terms"), F.ceil(F.col("n") * F.size("terms") / PAIRS)))
    sliced = held.join(crowds, "text_id").select("text_id", "terms", slices.cast("int").alias("slices"))
    terms = sliced.select("text_id", "slices", F.explode("terms").alias("term")).where(listed(F.col("term"), seen, "term"))
    terms = terms.select("text_id", "term", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice"))
    everywhere = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    classes = members.join(sliced.select("text_id", "slices"), "text_id").select("text_id", "class", everywhere)
    return terms.join(classes, ["text_id", "slice"]).select("text_id", "slice", "class", "term")


def disclosures(found: DataFrame) -> DataFrame:
    """Entities with the terms that reveal them: `kind`, `value`, `term`, `share` of the entity's information.

    `found` has `text`, its hash `text_id` and its `spans`.
    """
    known, _, scored = _revealing(found)
    return known.join(scored, "class").select("kind", "value", "term", "share")


def _ordered(spans: Column) -> Column:
    """Spans by kind as listed, then by start."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, *ADDED)])
    keyed = F.transform(
        spans, lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with every span replaced by the mark of its kind; overlapping spans are replaced as one, by the first."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def cut(done: Column, s: Column) -> Column:
        piece = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), mark(s["kind"]))
        out = F.when(s["start"] >= done["at"], piece).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(by_start, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def _sanitised(text: Column, spans: Column) -> Column:
    marks = F.create_map(*[F.lit(x) for pair in PLACEHOLDERS.items() for x in pair])
    return _replaced(text, spans, lambda kind: marks[kind])


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of docs, with `_spans` (kind, start, end; base kinds first) and `_sanitised`, the text without them.

    Spans are in code points with exclusive ends. Spans of the four base kinds
    may overlap one another; an added span never overlaps a base one.

    A NULL text has no spans and stays NULL; an empty text stays empty. Rows that
    share an id or are repeated are treated one by one, and give equal results
    for equal texts. A NULL id changes nothing. Further columns pass through
    whatever they are called. An empty table gives an empty result.
    """
    mark = f"_{uuid.uuid4().hex[:8]}_"
    raw = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(text_column).cast("string").alias("text")
    ).withColumn("text_id", F.xxhash64("text"))
    found = written(raw.withColumn("spans", F.coalesce(base_spans(F.col("text")), F.expr(f"cast(array() as array<{_SPAN}>)"))), "found")

    _, members, scored = _revealing(found)
    kind = F.when(F.col("share") >= REMOVE, "removed").otherwise("generalised")
    held = found.where(F.size("spans") > 0)
    terms = members.join(scored, "class").groupBy("text_id", "term").agg(F.max("share").alias("share"))
    terms = terms.groupBy("text_id").agg(F.map_from_entries(F.collect_list(F.struct("term", kind))).alias("terms"))

    joined = held.join(terms, "text_id", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys("terms"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    added = _find_all(F.col("text"), pattern, "removed")
    clear = lambda s: ~F.exists("spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    named = F.transform(
        F.filter(added, clear),
        lambda s: F.struct(
            F.coalesce(F.element_at("terms", F.lower(s["value"])), F.lit("generalised")).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")
        ),
    )
    joined = joined.withColumn("spans", F.when(F.col("terms").isNull(), F.col("spans")).otherwise(F.concat("spans", named)))
    rows = found.where(F.size("spans") == 0).select("row", "text", "spans").union(joined.select("row", "text", "spans"))
    rows = rows.select("row", F.col("text").alias(f"{mark}t"), _ordered(F.col("spans")).alias(f"{mark}s"))
    own = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return rows.select(*own, F.col(f"{mark}s").alias("_spans"), _sanitised(F.col(f"{mark}t"), F.col(f"{mark}s")).alias("_sanitised"))


def joined_spans(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of each span, comma-joined; of some kinds only if given."""
    kept = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
