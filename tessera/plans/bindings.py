"""Views that put the driver tables into the shapes the reference works on.

Each binding is a plain DataFrame plan over the parquet tables, so its work
grows with the data.  The DuckDB text of the same view lives in
``tessera.plans.oracle`` and is written independently from the same rules.

Join strategy: ``nation`` x ``region`` is a fixed-size dimension (25 rows by
the TPC-H definition), broadcast after a row-count check.  Part, customer and
supplier grow with the scale factor and are left to AQE: it turns a shuffle
join into a broadcast only when the measured runtime size is under
``spark.sql.autoBroadcastJoinThreshold`` (a checked bound); at 100 TB they stay
shuffle joins.  The fact sides (orders, lineitem) are never broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import list_text
from tessera.session import broadcast_if_small
from tessera.sources.tables import table

# --- fixed values of the bindings ---------------------------------------------
SMR_PRIORITY = "5-LOW"          # orders with this priority get release_type 'SMR'
VR_PRIORITY = "1-URGENT"        # orders with this priority are vr_qualified
BASE_STATUS = "O"               # linestatus of base apps
VARIANT_STATUS = "F"            # linestatus of variant apps
SUPPLIER_FP_TAIL = "x"          # third part of the supplier fingerprint
LINES_PER_TURN = 1 << 32        # line numbers of one turn
MAX_GEO_ROWS = 100_000          # broadcast bound for the nation x region dimension
# ------------------------------------------------------------------------------


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation_key -> 'region/nation' in lower case (25 rows; broadcast after a size check)."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    g = n.join(r, n.n_regionkey == r.r_regionkey)
    return broadcast_if_small(g.select("n_nationkey", F.lower(F.concat_ws("/", "r_name", "n_name")).alias("geo")),
                              MAX_GEO_ROWS)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: sorted distinct base / variant brands and the first line's supplier.

    One shuffle of lineitem on l_orderkey; the per-order sets are bounded by
    the brand vocabulary, and the first supplier is a ``min`` of a struct, so
    partial aggregation keeps the shuffle small.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus")
    part = table(spark, sf_dir, "part", "p_partkey", "p_brand")
    lp = li.join(part, li.l_partkey == part.p_partkey, "left")
    return lp.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set(F.when(F.col("l_linestatus") == BASE_STATUS, F.col("p_brand")))).alias("base_brands"),
        F.array_sort(F.collect_set(F.when(F.col("l_linestatus") == VARIANT_STATUS, F.col("p_brand")))).alias("var_brands"),
        F.min(F.struct("l_linenumber", "l_suppkey")).getField("l_suppkey").alias("first_suppkey"),
    )


def config_rows(spark: SparkSession, sf_dir: str, by_customer: bool = False, orders: DataFrame | None = None,
                lines: DataFrame | None = None) -> DataFrame:
    """One configuration row per order (see SURVEY §7.2 ``config_rows``).

    Columns: rid, device, build_type, release_type, vr_qualified, fingerprint,
    same_device_fingerprints, priv_base_apps, priv_var_apps (all text but rid).
    ``by_customer`` makes the customer name the device (``config_by_customer``).
    ``orders`` may be given -- e.g. a stream of orders; every other input is a
    static table, so the joins are stream-static joins.  ``lines`` may be given
    as a stored :func:`order_lines`, so that a stream does not aggregate them
    again for each micro-batch.
    """
    geo = geography(spark, sf_dir)
    o = (orders if orders is not None else table(spark, sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_name")
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    lines = order_lines(spark, sf_dir) if lines is None else lines
    # each dimension is joined raw, then its geography: the planner's size
    # check sees the dimension's own file size (a join-of-joins estimate is
    # the product of its inputs and would never pass the check)
    cgeo = geo.select(F.col("n_nationkey").alias("c_nat"), F.col("geo").alias("c_geo"))
    sgeo = geo.select(F.col("n_nationkey").alias("s_nat"), F.col("geo").alias("s_geo"))
    df = (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey, "left")
          .join(cgeo, F.col("c_nationkey") == F.col("c_nat"), "left")
          .join(s, F.col("first_suppkey") == s.s_suppkey, "left")
          .join(sgeo, F.col("s_nationkey") == F.col("s_nat"), "left")
          .withColumn("c_device", F.col("c_name" if by_customer else "c_mktsegment")))
    empty = F.array().cast("array<string>")
    return df.select(
        F.col("o_orderkey").alias("rid"),
        F.col("c_device").alias("device"),
        F.col("o_orderstatus").alias("build_type"),
        F.when(F.col("o_orderpriority") == SMR_PRIORITY, F.lit("SMR")).otherwise(F.col("o_orderpriority")).alias("release_type"),
        F.when(F.col("o_orderpriority") == VR_PRIORITY, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("vr_qualified"),
        F.lower(F.concat("c_geo", F.lit("/"), "o_orderpriority")).alias("fingerprint"),
        F.when(F.col("s_geo").isNotNull(), F.concat(F.col("s_geo"), F.lit("/" + SUPPLIER_FP_TAIL))).alias("same_device_fingerprints"),
        list_text(F.coalesce("base_brands", empty)).alias("priv_base_apps"),
        list_text(F.coalesce("var_brands", empty)).alias("priv_var_apps"),
    )


# analyzer dialect column names -> canonical names
ANALYZER_RENAMES = {
    "same_device_fingerprint": "same_device_fingerprints",
    "priv_app_in_base_only": "priv_base_apps",
    "priv_app_in_variant_only": "priv_var_apps",
}


def to_canonical(df: DataFrame) -> DataFrame:
    """Rename the analyzer dialect's columns to the report's names."""
    for old, new in ANALYZER_RENAMES.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


# --- ordered series, id sets, tickets ----------------------------------------------

def events_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as rows (g, ts, event_id, v, x, y), in time order by (ts, event_id) but without a position."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value", "props")
    return ev.select(F.col("user_id").alias("g"), "ts", "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("v"),
                     F.floor("value").cast("bigint").alias("y")).withColumn("x", F.col("v"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as one ordered series per user: (g, pos, v, x, y).

    g = user_id; pos = 0-based order by (ts, event_id); v = x = integer ``k``
    of the ``props`` JSON; y = floor(value).  Positions come from the
    skew-safe ``row_number`` (a user may hold a third of all events).
    """
    from tessera.operators import segmented
    r = segmented.ranked(events_in_time(spark, sf_dir), ["g"], ["ts", "event_id"], out="_rn", method="row_number")
    return r.select("g", (F.col("_rn") - 1).alias("pos"), "v", "x", "y")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ticket content: (seq, ticket_id, content).

    seq = event_id, ticket_id = user_id as text, content = event_type ':'
    floor(value).  About 1,000 distinct contents at sf0.01, so tickets get
    many versions, repeats, and a batch half with genuinely new content.
    """
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    return ev.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("ticket_id"),
                     F.concat("event_type", F.lit(":"), F.floor("value").cast("bigint").cast("string")).alias("content"))


def ticket_store_and_batch(spark: SparkSession, sf_dir: str):
    """Split tickets at the middle ``seq`` (max(seq) div 2): stored rows and a new batch."""
    t = tickets(spark, sf_dir)
    mid = t.agg(F.max("seq").alias("m")).select(F.expr("m div 2")).scalar()   # scalar subquery, one value
    return t.where(F.col("seq") <= mid), t.where(F.col("seq") > mid)


def conversation_turns_minus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of each conversation but one: (g, v).

    The one left out is the characters of the conversation modulo its turns, so
    it differs between conversations.
    """
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    whole = c.groupBy("conv_id").agg(F.pmod(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count(F.lit(1))).alias("out"))
    left = c.select(F.col("conv_id").alias("g"), F.col("turn").alias("v")).join(whole, F.col("g") == F.col("conv_id"))
    return left.where(F.col("v") != F.col("out")).select("g", "v")


# --- documents -----------------------------------------------------------------------

def pages_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as paged documents: (doc_id, page_no, text)."""
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_no"), "text")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-output-shaped lines per conversation: (doc_id, line_no, line).

    Turn t gives 'TOPIC: <role>' and one 'FACT: <line>' per line of its text.
    Line numbers are turn * LINES_PER_TURN plus the place in the turn.
    """
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    facts = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.concat(F.lit("FACT: "), x))
    every = F.concat(F.array(F.concat(F.lit("TOPIC: "), F.col("role"))), facts)
    at = c.select(F.col("conv_id").alias("doc_id"), "turn", F.posexplode(every).alias("i", "line"))
    return at.select("doc_id", (F.col("turn").cast("bigint") * LINES_PER_TURN + F.col("i")).alias("line_no"), "line")


def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token bag of all ``benchmark`` texts: (term, qtf) -- the relevance query."""
    from tessera.operators.documents import term_counts
    b = table(spark, sf_dir, "benchmark", "item_id", "text")
    return term_counts(b, [], "text").withColumnRenamed("tf", "qtf")


def vectors_and_queries(spark: SparkSession, sf_dir: str):
    """``embeddings`` and one query per label: its lowest vec_id."""
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    q = e.groupBy("label").agg(F.min(F.struct("vec_id", "embedding")).alias("q")).select(
        F.col("q.vec_id").alias("query_id"), F.col("label").alias("query_label"), F.col("q.embedding").alias("query_vec"))
    return e.select("vec_id", "embedding"), q


# --- hierarchies ---------------------------------------------------------------------

def geo_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region -> nation -> customer as one node table.

    node ids 'r:<key>', 'n:<key>', 'c:<key>'; values: region key, nation key,
    customer balance in cents.
    """
    r = table(spark, sf_dir, "region", "r_regionkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    cols = ["node_id", "parent_id", "side", "value"]
    rows = [
        r.select(F.concat(F.lit("r:"), F.col("r_regionkey").cast("string")).alias("node_id"),
                 F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("string").alias("side"),
                 F.col("r_regionkey").cast("bigint").alias("value")),
        n.select(F.concat(F.lit("n:"), F.col("n_nationkey").cast("string")),
                 F.concat(F.lit("r:"), F.col("n_regionkey").cast("string")), F.lit(None).cast("string"),
                 F.col("n_nationkey").cast("bigint")),
        c.select(F.concat(F.lit("c:"), F.col("c_custkey").cast("string")),
                 F.concat(F.lit("n:"), F.col("c_nationkey").cast("string")), F.lit(None).cast("string"),
                 F.round(F.col("c_acctbal") * 100).cast("bigint")),
    ]
    out = rows[0].toDF(*cols)
    for x in rows[1:]:
        out = out.unionByName(x.toDF(*cols))
    return out.withColumn("tree_id", F.lit(0))


# fixed values: operator of each order's root by status
ROOT_OP = {"O": -1, "F": -4}
ROOT_OP_OTHER = -2


def formula_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One expression tree per order with lines:
    root(op by status; O add, F multiply, else subtract) over
    (L: total quantity, R: divide(subtract(sum of line numbers, 3 x lines), lines))."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_linenumber")
    a = li.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("q"),
                                     F.sum("l_linenumber").cast("bigint").alias("a"), F.count(F.lit(1)).alias("c"))
    t = o.join(a, o.o_orderkey == a.l_orderkey)
    root_op = F.when(F.col("o_orderstatus") == "O", F.lit(ROOT_OP["O"])).when(
        F.col("o_orderstatus") == "F", F.lit(ROOT_OP["F"])).otherwise(F.lit(ROOT_OP_OTHER))

    key = F.col("o_orderkey").cast("string")

    def node(i, parent, side, value):
        pid = F.lit(None).cast("string") if parent is None else F.concat(key, F.lit(f":{parent}"))
        return F.struct(F.concat(key, F.lit(f":{i}")).alias("node_id"), pid.alias("parent_id"),
                        F.lit(side).cast("string").alias("side"), value.cast("bigint").alias("value"))

    nodes = F.array(node(0, None, None, root_op), node(1, 0, "L", F.col("q")), node(2, 0, "R", F.lit(-3)),
                    node(3, 2, "L", F.lit(-2)), node(4, 3, "L", F.col("a")), node(5, 3, "R", F.col("c") * 3),
                    node(6, 2, "R", F.col("c")))
    return t.select(F.col("o_orderkey").alias("tree_id"), F.explode(nodes).alias("n")).select("tree_id", "n.*")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letter runs of every document, lower case: (word, occurrences)."""
    d = table(spark, sf_dir, "documents", "text")
    w = d.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))
