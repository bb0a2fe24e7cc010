"""Operator 6: line dedup with a fixed-depth log-template tree.

Each line is cut into tokens; tokens with a digit are variable fields.  The
tree routes a line by its token count and then by its leading tokens to a leaf.
In a leaf, lines whose tokens agree place by place in a share of at least
``similar`` belong to one template: the first line by document is the head,
the lines similar to it join, and what is left goes to the next head.  Before
that, lines whose tokens are not shared at enough places can join nobody and
are set aside, so a leaf needs few heads.  A template in ``min_docs`` documents
or more is boilerplate: its lines stay in its first document and are dropped
from all others.

Lines too short for a template (``short``) or with too few tokens that are no
fields (``literals``) are judged as well: each is its own leaf, and only lines
of the same tokens, digits included, are one.  Such equal lines recur in
``min_docs`` documents; lines that are only alike need ``like_docs``.

Everything is columns, aggregates and joins.  Lines travel as hashes.  Text is
moved only if the lists of wanted or dropped line numbers are too large to be
sent to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_light, kept_table, words

MIN_TOKENS = 5
LEADING = 3
SIMILAR = 0.8
MIN_DOCS = 2
WHOLE_JOB = {"short": True, "literals": 5, "like_docs": 5}  # the query and the pipeline's stage
FIELD = "<*>"
TOKEN = r"[^\x20\x09-\x0D]"
OTHER_SPACE = r"[\x09\x0B-\x0D]"


def _plain(text: Column) -> Column:
    """Whole text with only blanks and line ends as white space."""
    return F.when(text.rlike(OTHER_SPACE), F.regexp_replace(text, OTHER_SPACE, " ")).otherwise(text)


def _masked(text: Column) -> Column:
    """Whole text with every token that holds a digit made a field, and only blanks and line ends as white space."""
    return _plain(F.when(text.rlike("[0-9]"), F.regexp_replace(text, f"{TOKEN}*[0-9]{TOKEN}*", FIELD)).otherwise(text))


def _tokens(line: Column) -> Column:
    return F.filter(F.split(line, " "), lambda w: w != "")


def _lines(docs: DataFrame, min_tokens: int, leading: int, short: bool, literals: int) -> DataFrame:
    """doc_id, th, line, leaf, own, raw of every line with enough tokens; with ``short``, of every line with a token.

    ``raw`` tells lines apart that are one after masking; null without a field.
    """
    tokens = F.transform(F.split(_masked(F.col("text")), "\n"), _tokens)
    # the inner transform binds the tokens, which the outer one reads several times
    info = F.zip_with(tokens, F.split(_plain(F.col("text")), "\n"), lambda t, line: F.struct(
        F.size(t).alias("n"), F.size(F.filter(t, lambda w: w != FIELD)).alias("literals"), F.xxhash64(F.size(t), *[F.get(t, F.lit(k)) for k in range(leading)]).alias("leaf"),
        F.xxhash64(t).alias("own"), F.when(F.array_contains(t, FIELD), F.xxhash64(_tokens(line))).alias("raw")))
    rows = docs.select("doc_id", "th", F.posexplode_outer(info).alias("line", "x")).where(F.col("x.n") >= (1 if short else min_tokens))
    exact, same = (F.col("x.n") < min_tokens) | (F.col("x.literals") < literals), F.coalesce("x.raw", "x.own")
    return rows.select("doc_id", "th", "line", F.when(exact, same).otherwise(F.col("x.leaf")).alias("leaf"),
                       F.when(exact, same).otherwise(F.col("x.own")).alias("own"), F.when(~exact, F.col("x.raw")).alias("raw"))


def _with_key(docs: DataFrame, columns: list[str]) -> DataFrame:
    """A document is its id and its text: ``th`` tells documents that repeat an id apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*columns, text.alias("text"), F.xxhash64(text).alias("th"))


def templates(docs: DataFrame, lines: DataFrame, similar: float = SIMILAR, literals: int = 0) -> DataFrame:
    """leaf, own, head: the head of every line kind that joined another one's template."""
    kinds = lines.groupBy("leaf", "own").agg(F.min(F.struct("doc_id", "th", "line")).alias("first"))
    mixed = lines.groupBy("leaf").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select(F.col("leaf").alias("m"))
    kinds = kinds.join(mixed, F.col("leaf") == F.col("m"), "left_semi")
    # tokens of one line of each kind, read from its first document; a document's list is bounded by its lines
    wanted = kinds.groupBy(F.col("first.doc_id").alias("d"), F.col("first.th").alias("h")).agg(
        F.collect_list(F.struct("first", "leaf", "own")).alias("kinds"))
    wanted = broadcast_if_light(kept_table(wanted), F.size("kinds") * 64)
    found = (docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")))
             .select(F.split(_masked(F.col("text")), "\n").alias("all"), "kinds"))
    each = F.transform("kinds", lambda k: F.struct(k["leaf"].alias("leaf"), k["own"].alias("own"), k["first"].alias("first"),
                                                   _tokens(F.get("all", k["first"]["line"])).alias("tokens")))
    full = kept_table(found.select(F.explode_outer(each).alias("x")).select("x.*").dropDuplicates(["leaf", "own"]))
    # upper bound: places whose token another line of the leaf has too
    places = full.select("leaf", "own", F.posexplode_outer("tokens").alias("place", "token"))
    shared = places.groupBy("leaf", "place", "token").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select("leaf", "place", "token")
    fit = (places.join(shared, ["leaf", "place", "token"], "left_semi").groupBy("leaf", "own").agg(F.count(F.lit(1)).alias("k")))
    left = kept_table(full.join(fit, ["leaf", "own"]).where(F.col("k") >= F.size("tokens") * similar).select("leaf", "own", "tokens", "first"))
    done = None
    while not left.isEmpty():
        head = left.groupBy("leaf").agg(F.min(F.struct("first", "own", "tokens")).alias("h")).select(
            F.col("leaf").alias("l"), F.col("h.own").alias("head"), F.col("h.tokens").alias("want"))
        equal = F.size(F.filter(F.zip_with("tokens", "want", lambda a, b: a == b), lambda x: x))
        plain = F.size(F.filter(F.zip_with("tokens", "want", lambda a, b: (a == b) & (a != FIELD)), lambda x: x))
        met = kept_table(left.join(head, F.col("leaf") == F.col("l")).withColumn("joins", (equal >= F.size("tokens") * similar) & (plain >= literals)))
        joined = met.where("joins").select("leaf", "own", "head")
        done = joined if done is None else done.union(joined)
        left = met.where("not joins").select("leaf", "own", "tokens", "first")
    return done if done is not None else full.select("leaf", "own", F.col("own").alias("head")).limit(0)


def _after_first(lines: DataFrame, kind: str, min_docs: int) -> DataFrame:
    """doc_id, th, line of the lines whose (leaf, ``kind``) is in ``min_docs`` documents, without the first one's."""
    per_doc = lines.groupBy("leaf", kind, "doc_id", "th").agg(F.lit(1).alias("one"))
    recurring = (per_doc.groupBy("leaf", kind).agg(F.sum("one").alias("docs"), F.min(F.struct("doc_id", "th")).alias("first"))
                 .where(F.col("docs") >= min_docs).select(F.col("leaf").alias("l"), F.col(kind).alias("t"), "first"))
    return (lines.join(recurring, (F.col("leaf") == F.col("l")) & (F.col(kind) == F.col("t")))
            .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))))
            .select("doc_id", "th", "line"))


def dropped_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, leading: int = LEADING, similar: float = SIMILAR, min_docs: int = MIN_DOCS,
                  short: bool = False, literals: int = 0, like_docs: int | None = None) -> DataFrame:
    """doc_id, th, line of every line that recurs, itself or its template, and whose document is not the first; a line may come twice."""
    lines = kept_table(_lines(docs, min_tokens, leading, short, literals))
    heads = templates(docs, lines, similar, literals).withColumnRenamed("leaf", "l").withColumnRenamed("own", "o")
    same = _after_first(lines.withColumn("kind", F.coalesce("raw", "own")), "kind", min_docs)
    # only lines with a field or a head have a template of more than equal lines
    alike = lines.join(heads, (F.col("leaf") == F.col("l")) & (F.col("own") == F.col("o")), "left").where("raw is not null or head is not null")
    alike = alike.select("doc_id", "th", "line", "leaf", F.coalesce("head", "own").alias("template"))
    return same.union(_after_first(alike, "template", like_docs or min_docs))


def drop_recurring_lines(docs: DataFrame, keep: tuple[str, ...] = (), min_tokens: int = MIN_TOKENS, leading: int = LEADING,
                         similar: float = SIMILAR, min_docs: int = MIN_DOCS, short: bool = False, literals: int = 0,
                         like_docs: int | None = None) -> DataFrame:
    """doc_id, the columns ``keep``, text without the dropped lines, n_lines, n_dropped, n_long of every row.

    ``n_long`` counts the lines left that have ``min_tokens`` or more.  With
    ``short`` the lines below that are judged too, by all their tokens, as are lines with
    fewer than ``literals`` tokens that are no fields.  ``like_docs`` (without
    it ``min_docs``) holds for lines that are alike but not equal.  Null
    counts as empty (no line dropped).  Rows that repeat an id and its text are
    one document and change alike; a null id sorts first.  Other columns are not
    read; an empty table gives an empty result.
    """
    keyed = _with_key(docs, ["doc_id"])
    gone = dropped_lines(keyed, min_tokens, leading, similar, min_docs, short, literals, like_docs)
    gone = gone.groupBy("doc_id", "th").agg(F.collect_set("line").alias("gone"))  # bounded by the document's lines
    gone = kept_table(gone.select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "gone"))
    gone = broadcast_if_light(gone, F.size("gone") * 4)
    rows = _with_key(docs, ["doc_id", *keep])
    out = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left")
    out = out.select("doc_id", *keep, F.split("text", "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    out = out.select("doc_id", *keep, F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
                     F.when(F.size("gone") == 0, F.col("lines")).otherwise(
                         F.filter("lines", lambda x, i: ~F.array_contains("gone", i))).alias("left"))
    return out.select("doc_id", *keep, F.array_join("left", "\n").alias("text"), "n_lines", "n_dropped",
                      F.when(F.col("n_dropped") > 0, F.size(F.filter("left", lambda x: F.size(words(x)) >= min_tokens)))
                      .otherwise(F.col("n_lines")).cast("long").alias("n_long"))
