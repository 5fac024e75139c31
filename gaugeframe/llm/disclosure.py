"""Information-theoretic sanitisation of personal data, in built-in functions only.

Identifiers (addresses, numbers) are the protected entities.  The words around their
mentions are counted over the corpus; a word reveals an entity as far as its pointwise
mutual information with the entity reaches the entity's own information content:

    PMI(c; t) / IC(c) = log2(n_ct * N / (n_c * n_t)) / log2(N / n_c)

with ``n_c`` mentions of the entity in different contexts, ``n_ct`` of them with the word,
``n_t`` documents with the word and ``N`` documents.  Words at or above a threshold are
sanitised wherever they occur: those that hold digits are generalised by masking the
digits, others are replaced by a class, and those that reveal nearly all are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.rows import packed_rows
from gaugeframe.storage import cut_lineage

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT_WORDS = 10
CONTEXT_CHARACTERS = 400
MIN_SUPPORT = 3
THRESHOLD = 0.8
REMOVE_FROM = 0.95
BROADCAST_ROWS = 1_000_000

# The patterns of the identifiers.  Possessive repeats and look-behind keep them linear on
# long runs; they match the same ranges as the plain forms.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# What stands between terms.
EDGE = r"[\x20\x09-\x0D.,;:!?()\[\]{}\"']"

FOUND = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>"


def identifiers(text: Column) -> Column:
    """Identifiers of a text with the text around each; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    digit = text.rlike("[0-9]")
    found = [
        _located(text, EMAIL, "email", text.contains("@"), lambda m: F.lit(True)),
        _located(text, IP, "ip", digit, lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        _located(text, CARD, "card", digit, _luhn),
        _located(text, PHONE, "phone", text.contains("+"), lambda m: _digits(m).between(10, 15)),
    ]
    return F.concat(*found)


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", ""))


def _luhn(match: Column) -> Column:
    """14 to 19 digits with a right check digit."""
    digits = F.reverse(F.translate(match, " -", ""))

    def weighed(digit: Column, place: Column) -> Column:
        value = digit.cast("int") * F.when(place % 2 == 1, 2).otherwise(1)
        return value - F.when(value > 9, 9).otherwise(0)

    total = F.aggregate(F.transform(F.split(digits, ""), weighed), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)


def _located(text: Column, pattern: str | Column, kind: str, possible: Column, valid) -> Column:
    """Matches with their places: the pieces between the matches give the places."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        one = F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            end.alias("end"),
            pair["match"].alias("value"),
            F.lit(None).cast("string").alias("before"),
            F.lit(None).cast("string").alias("after"),
        )
        kept = F.when(valid(pair["match"]), F.array_append(state["found"], one)).otherwise(state["found"])
        moved = F.struct(end.alias("at"), kept.alias("found"))
        return F.when(pair["match"].isNull(), state).otherwise(moved)

    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("found"))
    located = F.aggregate(pairs, start, step, lambda state: state["found"])

    def in_context(m: Column) -> Column:
        # Both sides are those of the whole text, whatever else the pattern matches there.
        begin = F.greatest(m["start"] - CONTEXT_CHARACTERS, F.lit(0))
        before = _last_words(F.substring(text, begin + 1, m["start"] - begin))
        after = _first_words(F.substring(text, m["end"] + 1, F.lit(CONTEXT_CHARACTERS)))
        return m.withField("before", before).withField("after", after)

    return F.when(possible, F.transform(located, in_context)).otherwise(F.array().cast(FOUND))


def _last_words(piece: Column) -> Column:
    return F.concat_ws(" ", F.slice(F.reverse(_terms(piece)), 1, CONTEXT_WORDS))


def _first_words(piece: Column) -> Column:
    return F.concat_ws(" ", F.slice(_terms(piece), 1, CONTEXT_WORDS))


def _terms(text: Column) -> Column:
    """The terms of a text: lower case, between white space and punctuation."""
    return F.split(F.lower(text), f"{EDGE}++")


def find_personal_data(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    min_support: int = MIN_SUPPORT,
    id_column: str = "doc_id",
    text_column: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All spans of every text: identifiers, and the terms that reveal them.

    One row per input row, repeated rows included: the id, a key of the text, and ``spans``,
    an array of (start, rank of the kind, kind, end, removed) in code points, end exclusive,
    ordered.  Contexts that are equal count once, so copies of a document do not add up.
    Null and empty texts have none; a null id is passed on; other columns are ignored.
    """
    texts = documents.select(
        documents[id_column].alias("id"), F.coalesce(documents[text_column], F.lit("")).alias("body")
    ).withColumn("text_key", F.xxhash64("body"))
    base = cut_lineage(texts.select("id", "text_key", identifiers(F.col("body")).alias("found")))
    # Of equal texts one is searched for terms; its spans are those of all.
    copies = base.groupBy("text_key").agg(F.min("id").alias("first"), F.count("*").alias("times")).filter("times > 1")
    copies = _small(cut_lineage(copies.select("text_key", "first")), broadcast_rows)
    unique = texts.join(copies, "text_key", "left").filter("first is null or id <=> first").drop("first")
    revealing = _revealing_terms(base, unique, threshold, min_support, broadcast_rows)
    terms = _term_spans(unique, revealing, broadcast_rows)
    identified = F.transform("found", lambda m: _span(m["kind"], m["start"], m["end"], F.lit(False)))
    joined = base.join(terms, "text_key", "left")
    spans = F.array_sort(F.concat(identified, F.coalesce("terms", F.array().cast(SPANS))))
    return joined.select(F.col("id").alias(id_column), "text_key", spans.alias("spans"))


SPANS = "array<struct<start:int,rank:int,kind:string,end:int,removed:boolean>>"


def _span(kind: Column, start: Column, end: Column, removed: Column) -> Column:
    rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")
    return F.struct(
        start.cast("int").alias("start"), rank.alias("rank"), kind.alias("kind"),
        end.cast("int").alias("end"), removed.alias("removed"),
    )


def _revealing_terms(
    base: DataFrame, texts: DataFrame, threshold: float, min_support: int, broadcast_rows: int
) -> DataFrame:
    """(text_key, term, removed) of all terms that reveal an entity, wherever they occur."""
    mention = base.select(F.explode("found").alias("m")).select(
        F.concat_ws(":", "m.kind", F.lower(F.regexp_replace("m.value", "[ ()-]", ""))).alias("entity"),
        F.concat_ws(" ", "m.before", "m.after").alias("context"),
    )
    contexts = mention.distinct()
    mentions = contexts.groupBy("entity").agg(F.count("*").alias("n_c")).filter(F.col("n_c") >= min_support)
    words = contexts.select(
        "entity", F.explode(F.array_distinct(F.split("context", " "))).alias("term")
    ).filter(F.length("term") > 1)
    pairs = words.groupBy("entity", "term").agg(F.count("*").alias("n_ct")).filter(F.col("n_ct") >= min_support)
    pairs = cut_lineage(pairs.join(mentions, "entity"))
    n = base.select(F.countDistinct("text_key").alias("n")).first()["n"]

    def reaching(counted: DataFrame, terms: DataFrame) -> DataFrame:
        """Terms that reach the threshold if they are in the given texts only."""
        spread = _holding(counted, terms, broadcast_rows).groupBy("term").agg(F.count("*").alias("n_t"))
        mutual = F.log2(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t")))
        # An entity in every document has no information, so nothing reveals it.
        scored = pairs.join(spread, "term").withColumn("ratio", F.try_divide(mutual, F.log2(n / F.col("n_c"))))
        reached = scored.filter(F.col("ratio") >= threshold)
        return cut_lineage(reached.groupBy("term").agg(F.max("ratio").alias("ratio")))

    # A word is in no fewer texts than in those with identifiers.  What is too common there
    # cannot reach the threshold, and is not looked for in all the others.
    holders = _small(base.filter(F.size("found") > 0).select("text_key").distinct(), broadcast_rows)
    possible = reaching(texts.join(holders, "text_key", "left_semi"), pairs.select("term").distinct())
    chosen = reaching(texts, possible.select("term"))
    chosen = cut_lineage(chosen.select("term", (F.col("ratio") >= REMOVE_FROM).alias("removed")))
    return _holding(texts, chosen, broadcast_rows, "inner")


def _holding(texts: DataFrame, terms: DataFrame, broadcast_rows: int, how: str = "left_semi") -> DataFrame:
    """(text_key, term) of the given terms in the texts, each once per text."""
    words = texts.select("text_key", F.explode(F.array_distinct(_terms(F.col("body")))).alias("term"))
    return words.join(_small(terms, broadcast_rows), "term", how)


def _term_spans(texts: DataFrame, hits: DataFrame, broadcast_rows: int) -> DataFrame:
    """Places of the revealing terms in the texts that hold them."""
    wanted = cut_lineage(hits.groupBy("text_key").agg(F.collect_list(F.struct("term", "removed")).alias("wanted")))
    chosen = texts.join(_small(wanted, broadcast_rows), "text_key")
    removed = F.map_from_entries("wanted")
    plain = F.concat_ws("|", F.transform("wanted", lambda w: F.concat(F.lit("\\Q"), w["term"], F.lit("\\E"))))
    pattern = F.concat(F.lit(rf"(?iu)(?:^|(?<={EDGE}))(?:"), plain, F.lit(rf")(?=\z|{EDGE})"))
    found = _located(F.col("body"), pattern, "term", F.lit(True), lambda m: F.lit(True))
    spans = F.transform(
        found,
        lambda m: _span(
            m["kind"], m["start"], m["end"], F.coalesce(F.element_at(removed, F.lower(m["value"])), F.lit(False))
        ),
    )
    located = chosen.select("text_key", spans.alias("terms"))
    return _small(cut_lineage(located.groupBy("text_key").agg(F.first("terms").alias("terms"))), broadcast_rows)


def _small(rows: DataFrame, broadcast_rows: int) -> DataFrame:
    """Broadcast only what has been counted and is small; otherwise the join shuffles."""
    few = rows.limit(broadcast_rows + 1).count() <= broadcast_rows
    return F.broadcast(rows) if few else rows


def sanitised(body: Column, spans: Column) -> Column:
    """The text with every span replaced; where spans overlap, the first one is."""

    def step(state: Column, span: Column) -> Column:
        value = F.substring(body, span["start"] + 1, span["end"] - span["start"])
        general = F.when(value.rlike("[0-9]"), F.regexp_replace(value, "[0-9]", "0")).otherwise("<TERM>")
        word = F.when(span["removed"], "").otherwise(general)
        label = F.when(span["kind"] == "term", word).otherwise(F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">")))
        kept = F.substring(body, state["at"] + 1, span["start"] - state["at"])
        moved = F.struct(span["end"].alias("at"), F.concat(state["text"], kept, label).alias("text"))
        return F.when(span["start"] < state["at"], state).otherwise(moved)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    return F.aggregate(
        spans, start, step, lambda s: F.concat(s["text"], F.substring(body, s["at"] + 1, F.length(body)))
    )


def sanitise(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents with sanitised texts; null texts stay null.

    Texts and spans meet on a key of the text, so repeated rows and null ids are handled;
    all columns are kept.
    """
    spans = find_personal_data(documents, id_column=id_column, text_column=text_column, **options)
    per_text = spans.groupBy("text_key").agg(F.first("spans").alias("spans"))
    body = F.col(f"row.`{text_column}`")
    keyed = packed_rows(documents).withColumn("text_key", F.xxhash64(F.coalesce(body, F.lit(""))))
    joined = keyed.join(per_text, "text_key", "left")
    text = F.when(body.isNull(), None).otherwise(sanitised(body, F.col("spans")))
    return joined.select(*[(text if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in documents.columns])
