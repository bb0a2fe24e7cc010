"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through the bindings) and returns a flat
result whose column names equal those of the DuckDB text in
``tessera.plans.oracle``.  Arrays are rendered with ``array_join`` at this
last step only, so both engines print them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import profiles
from tessera.plans import bindings
from tessera.session import scratch_path, shared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# -- step 1: flagship ----------------------------------------------------------

@register("fingerprint_stats")
def fingerprint_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S08 + F01 + F02 + P03 + P14 + A01 + A05 + A06: rows, total and distinct
    apps and averages -- overall, per device, per build type x device."""
    merged = profiles.merged_report_rows(bindings.config_rows(spark, sf_dir))
    return profiles.level_statistics(merged)


def _joined(col: str, sep: str = "|"):
    """Render an array column as text for engine-neutral comparison."""
    return F.array_join(F.col(col), sep).alias(col)


# -- step 2: report counts, top-k, relations ------------------------------------

@register("top_apps")
def top_apps(spark, sf_dir):
    """A03 + K01 + F13: ten most listed base / variant apps over merged rows."""
    from tessera.functions.text import short_label
    merged = profiles.merged_report_rows(bindings.config_rows(spark, sf_dir))
    top = profiles.top_k(profiles.app_counts(merged), ["side"], [F.desc("n"), F.asc("app")], 10)
    return top.select("side", "rank", "app", short_label("app").alias("label"), "n")


@register("top_combos")
def top_combos(spark, sf_dir):
    """Ten most frequent 'FP vs SDP' combinations over merged rows."""
    merged = profiles.merged_report_rows(bindings.config_rows(spark, sf_dir))
    counts = merged.groupBy(profiles.combo_label().alias("combo")).agg(F.count(F.lit(1)).alias("n"))
    return profiles.top_k(counts.withColumn("g", F.lit(0)), ["g"], [F.desc("n"), F.asc("combo")], 10).select("rank", "combo", "n")


@register("distinct_values")
def distinct_values(spark, sf_dir):
    """U05 + W13: distinct devices and build types in first-seen order."""
    return profiles.distinct_in_order(bindings.config_rows(spark, sf_dir), ["device", "build_type"])


@register("raw_combinations")
def raw_combinations(spark, sf_dir):
    """J02 + A02 + F03 + P04: observed raw combinations with ordered app lists."""
    rc = profiles.raw_combinations(bindings.config_rows(spark, sf_dir))
    return rc.select(*[c for c in rc.columns if c not in ("base", "variant")], _joined("base"), _joined("variant"))


@register("app_profile")
def app_profile(spark, sf_dir):
    """A04 + A13 + A14 + F25: app distribution per (device, build_type) section."""
    return profiles.app_profile(shared(profiles.raw_combinations(bindings.config_rows(spark, sf_dir))))


@register("app_frequency")
def app_frequency(spark, sf_dir):
    """how often each app is listed in a section, per side."""
    return profiles.app_counts(profiles.raw_combinations(bindings.config_rows(spark, sf_dir)), ["device", "build_type"])


@register("build_type_relation")
def build_type_relation(spark, sf_dir):
    """W07 + U03 + U04: neighbouring build-type app sets per customer."""
    merged = profiles.merged_report_rows(bindings.config_rows(spark, sf_dir, by_customer=True))
    return profiles.build_type_relation(merged)


@register("build_counts")
def build_counts(spark, sf_dir):
    """Merged rows and combinations per (device, build_type)."""
    return profiles.build_counts(profiles.merged_report_rows(bindings.config_rows(spark, sf_dir)))


@register("merge_audit")
def merge_audit(spark, sf_dir):
    """Preprocessing audit as one row."""
    return profiles.merge_audit(profiles.parse_report_rows(bindings.config_rows(spark, sf_dir)))


# -- step 3: analyzer counters ---------------------------------------------------

def _analyzer(spark, sf_dir, materialise: bool = False):
    from tessera.operators import analyzer
    rows = analyzer.analyzer_rows(bindings.config_rows(spark, sf_dir))
    return shared(rows) if materialise else rows


@register("release_counts")
def release_counts(spark, sf_dir):
    """P01 + P02 + F04 + F05 + A07: entries per (device, release_type)."""
    from tessera.operators import analyzer
    return analyzer.release_counts(_analyzer(spark, sf_dir))


@register("fp_app_counts")
def fp_app_counts(spark, sf_dir):
    """App counts per (device, release_type, fingerprint, side)."""
    from tessera.operators import analyzer
    return analyzer.keyed_app_counts(_analyzer(spark, sf_dir), "fp")


@register("same_fp_app_counts")
def same_fp_app_counts(spark, sf_dir):
    """App counts per (device, release_type, same-device fingerprint, side)."""
    from tessera.operators import analyzer
    return analyzer.keyed_app_counts(_analyzer(spark, sf_dir), "sdp")


@register("pair_counts")
def pair_counts(spark, sf_dir):
    """A10 + K07: co-occurring app pairs (sorted lists, duplicates kept)."""
    from tessera.operators import analyzer
    return analyzer.pair_counts(_analyzer(spark, sf_dir))


@register("list_errors")
def list_errors(spark, sf_dir):
    """per device, the counted rows and those whose list text did not parse."""
    from tessera.operators import analyzer
    return analyzer.list_errors(_analyzer(spark, sf_dir))


@register("report_list_errors")
def report_list_errors(spark, sf_dir):
    """F04 on texts of which half are not lists: the flag must find them."""
    from tessera.functions.text import list_parse_error
    from tessera.sources.tables import table
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    name = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("'"), "c_name", F.lit("'"))).otherwise(F.col("c_name"))
    return c.groupBy(F.col("c_mktsegment").alias("device")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(list_parse_error(F.concat(F.lit("["), name, F.lit("]"))), 1)).alias("n_errors"))


@register("analyzer_report")
def analyzer_report(spark, sf_dir):
    """S12 (analyzer): ten most frequent apps and five most frequent pairs per side."""
    from tessera.operators import analyzer
    return analyzer.report_tops(_analyzer(spark, sf_dir, materialise=True))


@register("device_release_share")
def device_release_share(spark, sf_dir):
    """Totals per device and per release type with their share."""
    from tessera.operators import analyzer
    return analyzer.device_release_share(analyzer.release_counts(_analyzer(spark, sf_dir)))


@register("topk_fingerprints")
def topk_fingerprints(spark, sf_dir):
    """K03 + W08: top devices, their top fingerprints and top apps."""
    from tessera.operators import analyzer
    return analyzer.top_fingerprints(_analyzer(spark, sf_dir, materialise=True))


@register("headline")
def headline(spark, sf_dir):
    """K08 + A12: headline numbers of the analyzer report."""
    from tessera.operators import analyzer
    return analyzer.headline(_analyzer(spark, sf_dir, materialise=True))


# -- step 5: ordered series and id sets -----------------------------------------

PAIR_TARGET = 100


@register("smaller_count")
def smaller_count(spark, sf_dir):
    """Per user, how many values are smaller than each value."""
    from tessera.operators import series
    return series.smaller_count(bindings.series(spark, sf_dir).select("g", "pos", "v"))


@register("best_rise")
def best_rise(spark, sf_dir):
    """Per user, best rise over the lowest earlier value."""
    from tessera.operators import series
    return series.best_rise(bindings.events_in_time(spark, sf_dir).select("g", "ts", "event_id", "v"), ("ts", "event_id"))


@register("path_length")
def path_length(spark, sf_dir):
    """W03 + F18: per user, Chebyshev path length through (x, y) in order."""
    from tessera.operators import series
    return series.path_length(bindings.events_in_time(spark, sf_dir).select("g", "ts", "event_id", "x", "y"), ("ts", "event_id"))


@register("pair_sum")
def pair_sum(spark, sf_dir):
    """Per user, the first index pair whose values sum to 100."""
    from tessera.operators import series
    return series.pair_sum(bindings.series(spark, sf_dir).select("g", "pos", "v"), PAIR_TARGET)


@register("has_duplicates")
def has_duplicates(spark, sf_dir):
    """Per user, whether any value repeats."""
    from tessera.operators import series
    return series.has_duplicates(bindings.events_in_time(spark, sf_dir).select("g", "v"))


@register("missing_ids")
def missing_ids(spark, sf_dir):
    """Order keys 0..max(o_orderkey) that have no line items."""
    from tessera.operators import series
    from tessera.sources.tables import table
    present = table(spark, sf_dir, "lineitem", "l_orderkey").select(F.col("l_orderkey").alias("id"))
    bounds = table(spark, sf_dir, "orders", "o_orderkey").agg(F.lit(0).cast("bigint").alias("lo"), F.max("o_orderkey").alias("hi"))
    return series.missing_ids(present, bounds)


@register("missing_by_sum")
def missing_by_sum(spark, sf_dir):
    """The one turn left out of each conversation, by the sum formula."""
    from tessera.operators import series
    out = series.missing_by_sum(bindings.conversation_turns_minus_one(spark, sf_dir))
    return out.withColumnRenamed("g", "conv_id")


@register("id_membership")
def id_membership(spark, sf_dir):
    """Orders per status with / without line items (semi / anti join)."""
    from tessera.operators import series
    from tessera.sources.tables import table
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem", "l_orderkey")
    with_lines = series.membership(o, li, "o_orderkey", "l_orderkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("with_lines"))
    total = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    return total.join(with_lines, "o_orderstatus", "left").select(
        "o_orderstatus", "n_orders", F.coalesce("with_lines", F.lit(0).cast("bigint")).alias("with_lines"),
        (F.col("n_orders") - F.coalesce("with_lines", F.lit(0).cast("bigint"))).alias("without_lines"))


# -- step 6: content-hash dedup, versions, ingest ---------------------------------

@register("content_hash_dedup")
def content_hash_dedup(spark, sf_dir):
    """D01 + D02 + F12: first row of every content hash."""
    from tessera.operators import ingest
    return ingest.first_per_hash(bindings.tickets(spark, sf_dir))


@register("insert_if_absent")
def insert_if_absent(spark, sf_dir):
    """D03 + J08: created / exists / hash taken for each arriving row."""
    from tessera.operators import ingest
    return ingest.insert_if_absent(bindings.tickets(spark, sf_dir))


@register("versions")
def versions(spark, sf_dir):
    """D04 + W05 + W06: versions of each ticket's content."""
    from tessera.operators import ingest
    return ingest.versions(bindings.tickets(spark, sf_dir))


@register("latest")
def latest(spark, sf_dir):
    """D06 + K04 + A22: latest version per ticket."""
    from tessera.operators import ingest
    return ingest.latest(bindings.tickets(spark, sf_dir))


@register("batch_ingest")
def batch_ingest(spark, sf_dir):
    """D05 + J03 + W12: new rows of the second half against the first half."""
    from tessera.operators import ingest
    store, batch = bindings.ticket_store_and_batch(spark, sf_dir)
    return ingest.batch_ingest(store, batch)


# -- step 7: documents -------------------------------------------------------------

VECTOR_K = 10


@register("assemble_docs")
def assemble_docs(spark, sf_dir):
    """Conversations assembled from their turns as pages."""
    from tessera.operators import documents
    return documents.assemble_pages(bindings.pages_of(spark, sf_dir))


@register("chunks")
def chunks(spark, sf_dir):
    """800-character chunks every 700 characters of every document."""
    from tessera.operators import documents
    from tessera.sources.tables import document_scan
    return documents.chunk_rows(document_scan(spark, sf_dir))


@register("relevant_chunks")
def relevant_chunks(spark, sf_dir):
    """T01 + F09: top 15 chunks per long document against the benchmark terms."""
    from tessera.operators import documents
    from tessera.sources.tables import document_scan
    return documents.relevant_text(document_scan(spark, sf_dir), bindings.query_terms(spark, sf_dir))


@register("vector_topk")
def vector_topk(spark, sf_dir):
    """T02 + F10 + F11 + J06 + W11: ten nearest embeddings per label query."""
    from tessera.operators import documents
    vecs, qs = bindings.vectors_and_queries(spark, sf_dir)
    return documents.vector_topk(vecs, qs, VECTOR_K)


@register("topic_list")
def topic_list(spark, sf_dir):
    """T03 = F06 + F22 + W09: consolidated topic list (K05's cap is off)."""
    from tessera.operators import documents
    return documents.consolidate_topics(documents.list_items(bindings.lines(spark, sf_dir)))


def _fact_rows(spark, sf_dir):
    from tessera.operators import documents
    ln = bindings.lines(spark, sf_dir)
    topics = shared(documents.consolidate_topics(documents.list_items(ln)))
    return documents.section_facts(ln, topics), topics


@register("section_facts")
def section_facts(spark, sf_dir):
    """F07 = W04 + J05 + P13: facts under matched section headers."""
    return _fact_rows(spark, sf_dir)[0]


@register("facts_by_topic")
def facts_by_topic(spark, sf_dir):
    """A19 + A20 + T04: facts gathered per topic over all documents."""
    from tessera.operators import documents
    facts, topics = _fact_rows(spark, sf_dir)
    return documents.facts_by_topic(facts, topics)


@register("document_report")
def document_report(spark, sf_dir):
    """S12 (documents): documents, topics, facts and the facts of every topic as tidy rows."""
    from tessera.operators import documents
    facts, topics = _fact_rows(spark, sf_dir)
    return documents.report_numbers(facts, topics, bindings.pages_of(spark, sf_dir))


@register("batched_scores")
def batched_scores(spark, sf_dir):
    """Chunk scores from a numpy scorer in Arrow batches (mapInPandas)."""
    from tessera.operators import documents
    from tessera.sources.tables import document_scan, table
    ch = documents.chunk_rows(document_scan(spark, sf_dir))
    return documents.batched_scores(ch, table(spark, sf_dir, "benchmark", "item_id", "text"))


# -- step 8: pages --------------------------------------------------------------------

@register("page_titles")
def page_titles(spark, sf_dir):
    """P10 + P09: normalised page titles."""
    from tessera.operators import pages
    from tessera.sources.tables import table
    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return p.select("page_id", "url", pages.page_title().alias("title"))


@register("page_items")
def page_items(spark, sf_dir):
    """T07 + D07: paragraphs of every page in order."""
    from tessera.operators import pages
    from tessera.sources.tables import table
    return pages.page_items(table(spark, sf_dir, "pages", "page_id", "html"))


@register("issue_urls")
def issue_urls(spark, sf_dir):
    """The page address of every issue id."""
    from tessera.sources.tables import page_urls, table
    return page_urls(table(spark, sf_dir, "pages", "page_id"), "https://tracker.example/issues/", "page_id")


@register("comments_concat")
def comments_concat(spark, sf_dir):
    """A21 + P11: description and formatted later paragraphs per page."""
    from tessera.operators import pages
    from tessera.sources.tables import table
    return pages.comments_concat(table(spark, sf_dir, "pages", "page_id", "url", "html"))


# -- step 9: CSV import / export, editor operations, JSON sink ---------------------

@register("csv_scan")
def csv_scan(spark, sf_dir):
    """S01 + S02: a CSV of orders read as text by the plain, splittable reader, then counted."""
    from tessera.session import scratch_path
    from tessera.sources import csvfiles
    from tessera.sources.tables import table
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    path = csvfiles.write_csv(csvfiles.as_text_columns(table(spark, sf_dir, "orders", *cols)), scratch_path(spark, "orders-csv"))
    rows = csvfiles.read_csv(spark, path, required=cols)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("o_orderpriority")).alias("chars"))


SEARCH_TEXT = "Red"


def _csv_copy(spark, df, name):
    """Write ``df`` as quoted CSV (S11) to a scratch folder and read it back."""
    from tessera.session import scratch_path
    from tessera.sources import csvfiles
    path = csvfiles.write_csv(csvfiles.as_text_columns(df), scratch_path(spark, name))
    return csvfiles.read_quoted_csv(spark, path)


def _part_csv(spark, sf_dir):
    from tessera.sources.tables import table
    return _csv_copy(spark, table(spark, sf_dir, "part"), "part-csv")


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """S01-S03 + S11: documents (quotes, commas, newlines) written as CSV and read back."""
    from tessera.sources.tables import table
    return _csv_copy(spark, table(spark, sf_dir, "documents"), "documents-csv")


@register("search_any")
def search_any(spark, sf_dir):
    """Case-insensitive search over every column of the CSV copy of part."""
    from tessera.operators import csvedit
    return csvedit.search_any(_part_csv(spark, sf_dir), SEARCH_TEXT)


def _part_edits(spark, sf_dir):
    from tessera.sources.tables import table
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    key = F.col("p_partkey").cast("string").alias("p_partkey")
    e1 = p.where(F.col("p_size") >= 45).select(key, F.lit("p_name").alias("column"), F.upper("p_name").alias("value"), F.lit(1).alias("seq"))
    e2 = p.where(F.col("p_retailprice") > 1500).select(key, F.lit("p_brand").alias("column"),
                                                       F.concat("p_brand", F.lit("-X")).alias("value"), F.lit(2).alias("seq"))
    return e1.unionByName(e2)


@register("edit_rows")
def edit_rows(spark, sf_dir):
    """Cell edits (upper-case names of big parts, tag brands of dear parts)."""
    from tessera.operators import csvedit
    return csvedit.apply_edits(_part_csv(spark, sf_dir), _part_edits(spark, sf_dir), "p_partkey")


def _part_deletes(spark, sf_dir):
    from tessera.sources.tables import table
    p = table(spark, sf_dir, "part", "p_partkey", "p_size")
    return p.where(F.col("p_size") <= 5).select(F.col("p_partkey").cast("string").alias("p_partkey"))


@register("delete_rows")
def delete_rows(spark, sf_dir):
    """Delete small parts, then re-run the search."""
    from tessera.operators import csvedit
    kept = csvedit.delete_rows(_part_csv(spark, sf_dir), _part_deletes(spark, sf_dir), "p_partkey")
    return csvedit.search_any(kept, SEARCH_TEXT)


@register("listing")
def listing(spark, sf_dir):
    """P08 + W10: labels and record cursor over the search result."""
    from tessera.operators import csvedit
    df = _part_csv(spark, sf_dir).withColumn("_ord", F.col("p_partkey").cast("bigint"))
    found = csvedit.search_any(df.drop("_ord"), SEARCH_TEXT).withColumn("_ord", F.col("p_partkey").cast("bigint"))
    return csvedit.listing(df, found, "p_partkey", "_ord", "p_partkey", "p_name")


@register("json_nested")
def json_nested(spark, sf_dir):
    """S09 + F23 + P16: merged rows as JSON records, counters dropped."""
    from tessera.sources import sinks
    merged = profiles.merged_report_rows(bindings.config_rows(spark, sf_dir))
    return sinks.json_records(merged.drop("n_rows"), ["device", "build_type", "fp_code", "sdp_code"])


# -- step 10: text checks and hierarchies ---------------------------------------------

@register("anagram_groups")
def anagram_groups(spark, sf_dir):
    """groups of distinct document words that are anagrams of each other."""
    from tessera.functions.text import anagram_key
    w = bindings.words(spark, sf_dir)
    g = w.groupBy(anagram_key("word").alias("key")).agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("occurrences").alias("n_occurrences"),
        F.array_join(F.array_sort(F.collect_list("word")), "|").alias("words"))
    return g.where(F.col("n_words") > 1)


@register("bracket_check")
def bracket_check(spark, sf_dir):
    """whether the brackets of each document nest properly."""
    from tessera.functions.text import bracket_chars, brackets_balanced
    from tessera.sources.tables import table
    d = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", bracket_chars("text").alias("b"))
    return d.select("doc_id", F.length("b").alias("n_brackets"), brackets_balanced("b").alias("balanced"))


@register("branch_sums")
def branch_sums(spark, sf_dir):
    """Root-to-leaf sums over region -> nation -> customer."""
    from tessera.operators import hierarchy
    out = hierarchy.branch_sums(bindings.geo_tree(spark, sf_dir))
    return out.select("tree_id", "leaf_id", "root_id", "branch_sum", "depth", F.array_join("path", "/").alias("path"))


@register("metric_tree")
def metric_tree(spark, sf_dir):
    """H02 + F19: bottom-up evaluation of one expression tree per order."""
    from tessera.operators import hierarchy
    return hierarchy.evaluate(bindings.formula_forest(spark, sf_dir))


# -- step 4: insight text, sections, request lines, report rows ---------------------

@register("insight_text")
def insight_text(spark, sf_dir):
    """A23 + A24 + F16 + F17: rule-based insight text per (device, build_type)."""
    from tessera.operators import insights
    return insights.insight_text(insights.section_stats(shared(bindings.config_rows(spark, sf_dir))))


@register("insight_sections")
def insight_sections(spark, sf_dir):
    """insight text split into header / body sections."""
    from tessera.operators import insights
    return insights.insight_sections(insights.insight_text(insights.section_stats(shared(bindings.config_rows(spark, sf_dir)))))


@register("request_rows")
def request_rows(spark, sf_dir):
    """F27 + K09: numbered combination lines of each section's request text."""
    from tessera.operators import insights
    return insights.request_lines(shared(bindings.config_rows(spark, sf_dir)))


@register("request_summary")
def request_summary(spark, sf_dir):
    """summary and statistics lines of each section's request, as rows."""
    from tessera.operators import insights
    return insights.request_summary(profiles.raw_combinations(bindings.config_rows(spark, sf_dir)))


@register("report_rows")
def report_rows(spark, sf_dir):
    """The report's numbers as (section, rank, label, value) rows."""
    from tessera.sources import sinks
    merged = shared(profiles.merged_report_rows(bindings.config_rows(spark, sf_dir)))
    counts = profiles.app_counts(merged)
    top = profiles.top_k(counts, ["side"], [F.desc("n"), F.asc("app")], 10)
    combos = merged.groupBy(profiles.combo_label().alias("combo")).agg(F.count(F.lit(1)).alias("n"))
    top_c = profiles.top_k(combos.withColumn("g", F.lit(0)), ["g"], [F.desc("n"), F.asc("combo")], 10)
    overall = profiles.level_statistics(merged).where(F.col("level") == "overall")
    tidy = sinks.report_rows([
        ("top_base_apps", top.where(F.col("side") == "base"), "app", "n", "rank"),
        ("top_variant_apps", top.where(F.col("side") == "variant"), "app", "n", "rank"),
        ("top_combinations", top_c, "combo", "n", "rank"),
    ])
    stats = sinks.metric_rows(overall, "overall", ["total_rows", "total_base", "unique_base", "total_var",
                                                   "unique_var", "avg_base", "avg_var"])
    return tidy.unionByName(stats)


@register("run_summary")
def run_summary(spark, sf_dir):
    """S13 + A20: one row of run totals (devices, sections, combinations,
    distinct apps, documents, topics, facts)."""
    cfg = shared(bindings.config_rows(spark, sf_dir))
    rc = profiles.raw_combinations(cfg)
    merged = profiles.merged_report_rows(cfg)
    apps = profiles.app_counts(merged)
    facts, topics = _fact_rows(spark, sf_dir)
    a = rc.agg(F.count_distinct("device").alias("n_devices"),
               F.count_distinct("device", "build_type").alias("n_sections"),
               F.count(F.lit(1)).alias("n_combinations"))
    return a.select(
        "*",
        apps.agg(F.count(F.when(F.col("side") == "base", 1))).scalar().alias("n_base_apps"),
        apps.agg(F.count(F.when(F.col("side") == "variant", 1))).scalar().alias("n_variant_apps"),
        bindings.pages_of(spark, sf_dir).agg(F.count_distinct("doc_id")).scalar().alias("n_documents"),
        topics.agg(F.count(F.lit(1))).scalar().alias("n_topics"),
        facts.agg(F.count(F.lit(1))).scalar().alias("n_facts"))


# -- step 11: Structured Streaming ---------------------------------------------------

@register("stream_counts")
def stream_counts(spark, sf_dir):
    """ST01: release counts maintained over a stream of orders."""
    from tessera.streaming import jobs
    out = jobs.running_release_counts(spark, sf_dir, jobs.stream_table(spark, sf_dir, "orders"), jobs.fresh(spark, "st01"))
    return jobs.read_release_counts(spark, out)


def _counter_store(spark, sf_dir):
    from tessera.streaming import jobs
    store = jobs.running_app_counts(spark, sf_dir, jobs.stream_table(spark, sf_dir, "orders"), jobs.fresh(spark, "st01c"))
    return jobs.read_counters(spark, store)


@register("stream_app_counts")
def stream_app_counts(spark, sf_dir):
    """ST01 + A03: app counters kept as partial counts per micro-batch."""
    c = _counter_store(spark, sf_dir).where(F.col("kind") == "app")
    return c.select("side", F.col("a").alias("app"), "n")


@register("stream_pair_counts")
def stream_pair_counts(spark, sf_dir):
    """ST01 + A10: app-pair counters kept as partial counts per micro-batch."""
    c = _counter_store(spark, sf_dir).where(F.col("kind") == "pair")
    return c.select("side", F.col("a").alias("app_a"), F.col("b").alias("app_b"), "n")


def _ticket_stream(spark, sf_dir):
    from tessera.streaming import jobs
    ev = jobs.stream_table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("ticket_id"),
                     F.concat("event_type", F.lit(":"), F.floor("value").cast("bigint").cast("string")).alias("content"))


@register("stream_dedup")
def stream_dedup(spark, sf_dir):
    """ST02: first row of every content hash, kept as ticket rows arrive."""
    from tessera.streaming import jobs
    store = jobs.streaming_first_per_hash(spark, _ticket_stream(spark, sf_dir), jobs.fresh(spark, "st02"))
    return jobs.read_firsts(spark, store)


@register("stream_versions")
def stream_versions(spark, sf_dir):
    """ST03: ticket versions maintained batch by batch."""
    from tessera.streaming import jobs
    store = jobs.streaming_versions(spark, _ticket_stream(spark, sf_dir), jobs.fresh(spark, "st03"))
    return jobs.read_versions(spark, store).select("ticket_id", "content_hash", "first_seq", "content", "version", "is_latest")


@register("stream_csv")
def stream_csv(spark, sf_dir):
    """ST04 + S10: page titles appended to CSV as pages arrive, read back."""
    from tessera.operators import pages
    from tessera.sources import csvfiles
    from tessera.streaming import jobs
    p = jobs.stream_table(spark, sf_dir, "pages")
    res = p.select(F.col("page_id").cast("string").alias("page_id"), "url", pages.page_title().alias("title"))
    folder = jobs.streaming_csv(res, jobs.fresh(spark, "st04"))
    return csvfiles.read_quoted_csv(spark, folder)


# -- T06 and step 12: quarantine and quality metrics ------------------------------

@register("doc_quarantine")
def doc_quarantine(spark, sf_dir):
    """Documents that fail a per-document check, with the reason."""
    from tessera.operators import quality
    from tessera.sources.tables import table
    docs = quality.document_errors(table(spark, sf_dir, "documents", "doc_id", "text", "n_chars"))
    return quality.split_errors(docs)[1].select("doc_id", "error")


@register("p90_by_type")
def p90_by_type(spark, sf_dir):
    """90th percentile of event value per event type."""
    from tessera.operators import quality
    from tessera.sources.tables import table
    return quality.percentile_by(table(spark, sf_dir, "events", "event_type", "value"), "event_type", "value", 0.9)


@register("label_f1")
def label_f1(spark, sf_dir):
    """Precision / recall / F1 of 'not toxic' as a predictor of quality."""
    from tessera.operators import quality
    from tessera.sources.tables import table
    lab = table(spark, sf_dir, "labels", "quality", "toxic").select("quality", (1 - F.col("toxic")).alias("pred"))
    return quality.binary_metrics(lab, "quality", "pred")


@register("stream_dedup_watermark")
def stream_dedup_watermark(spark, sf_dir):
    """ST02 (bounded state): events de-duplicated on (user, event type, hour of
    the event) with ``dropDuplicatesWithinWatermark``; the kept keys are read
    back (which duplicate survives is not defined, so only keys are returned)."""
    from tessera.streaming import jobs
    out = jobs.hourly_keys(jobs.stream_table(spark, sf_dir, "events"), jobs.fresh(spark, "st02w"))
    return spark.read.parquet(out)


def _damaged_props(spark, sf_dir):
    """Events whose property text is cut short (every 7th id), has text for a number (every 11th) or is absent (every 13th)."""
    from tessera.sources.tables import table
    e = table(spark, sf_dir, "events", "event_id", "event_type", "value", "props")
    i = F.col("event_id")
    props = (F.when(i % 13 == 0, F.lit(None).cast("string")).when(i % 7 == 0, F.expr("left(props, length(props) - 1)"))
             .when(i % 11 == 0, F.replace("props", F.lit(": "), F.lit(": \"x"))).otherwise(F.col("props")))
    amount = F.when(i % 5 == 0, F.concat(F.col("event_type"), F.col("value").cast("string"))).otherwise(F.col("value").cast("string"))
    return e.select("event_id", props.alias("props"), amount.alias("amount"))


@register("event_quarantine")
def event_quarantine(spark, sf_dir):
    """Events with a field that cannot be read, the names of the fields and the values that could be."""
    from tessera.operators import quality
    parts = {"k": ("props", quality.json_field("props", "$.k", "bigint")), "amount_value": ("amount", F.expr("try_cast(amount AS double)"))}
    folder = scratch_path(spark, "quarantine")
    quality.quarantine(quality.isolated(_damaged_props(spark, sf_dir), parts), folder)
    return spark.read.parquet(folder).select("event_id", F.array_join("errors", ",").alias("errors"), "k", "amount_value")


@register("csv_rejects")
def csv_rejects(spark, sf_dir):
    """Parts as CSV lines of which some lack a field or have one too many: rows read and lines rejected, by kind."""
    from tessera.sources import csvfiles
    from tessera.sources.tables import table
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    k = F.col("p_partkey")
    quoted = F.concat(F.lit('"'), F.col("p_brand"), F.lit(', ""x"""'))
    line = (F.when(k % 7 == 0, F.concat_ws(",", k.cast("string"), quoted))
            .when(k % 11 == 0, F.concat_ws(",", k.cast("string"), quoted, F.col("p_size").cast("string"), F.lit("more")))
            .otherwise(F.concat_ws(",", k.cast("string"), quoted, F.col("p_size").cast("string"))))
    folder = scratch_path(spark, "damaged-csv")
    p.select(line.alias("value")).write.text(folder)
    good, bad = csvfiles.read_csv_with_rejects(spark, folder, ["k", "brand", "size"], header=False)
    fields = F.when(bad["line"].endswith(",more"), "too many").otherwise("too few")
    rows = good.select(F.lit("read").alias("kind"), F.concat_ws("|", "k", "brand", "size").alias("text"))
    rows = rows.unionByName(bad.select(fields.alias("kind"), F.col("line").alias("text")))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("first"), F.max("text").alias("last"))


@register("distinct_sketch_levels")
def distinct_sketch_levels(spark, sf_dir):
    """Distinct parts per supplier nation and ship mode, per nation and in all, from merged HLL sketches beside the exact count."""
    from tessera.operators import sketches
    from tessera.sources.tables import table
    li = table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_returnflag")
    rows = li.join(table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    levels = [["s_nationkey", "l_returnflag"], ["s_nationkey"], []]
    found = sketches.distinct_levels(rows, levels, "l_partkey")
    exact = rows.groupingSets([[F.col(k) for k in keys] for keys in levels], "s_nationkey", "l_returnflag").agg(
        F.count_distinct("l_partkey").alias("n_exact"), F.grouping_id().alias("g"))
    exact = exact.select(F.when(F.col("g") == 0, 0).when(F.col("g") == 1, 1).otherwise(2).alias("at"), F.col("s_nationkey").alias("a"), F.col("l_returnflag").alias("b"), "n_exact")
    same = (F.col("level") == F.col("at")) & F.col("s_nationkey").eqNullSafe(F.col("a")) & F.col("l_returnflag").eqNullSafe(F.col("b"))
    inside = F.abs(F.col("n_estimate") - F.col("n_exact")) <= F.greatest(F.lit(1.0), F.col("n_exact") * sketches.hll_bound())
    return found.join(exact, same).select("level", "s_nationkey", "l_returnflag", "n_exact", inside.alias("within_bound"))


@register("quantile_sketches")
def quantile_sketches(spark, sf_dir):
    """Median and p90 of the event value per type and in all from merged KLL sketches, by the exact rank of the answer."""
    from tessera.operators import sketches
    from tessera.sources.tables import table
    ev = table(spark, sf_dir, "events", "event_type", "value", "user_id").withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(8)))
    fine = sketches.quantile_sketches(ev, ["event_type", "part"], "value")
    by_type = sketches.merged_quantiles(fine, ["event_type"])
    both = by_type.unionByName(sketches.merged_quantiles(by_type, []).select(F.lit("(all)").alias("event_type"), "sketch"))
    asked = shared(both.select(F.col("event_type").alias("of"), F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), sketches.quantile(p).alias("q")) for p in (0.5, 0.9)])).alias("x")).select("of", "x.*"))
    # a few rows a type: the exact ranks come from one aggregate over the values
    rows = ev.select("event_type", "value").unionByName(ev.select(F.lit("(all)").alias("event_type"), "value"))
    ranks = rows.join(asked, F.col("event_type") == F.col("of")).groupBy("event_type", "p").agg(
        F.count("value").alias("n"), F.count(F.when(F.col("value") < F.col("q"), 1)).alias("below"), F.count(F.when(F.col("value") <= F.col("q"), 1)).alias("upto"))
    slack = F.col("n") * sketches.KLL_RANK_ERROR + 1
    target = F.col("n") * F.col("p")
    return ranks.select("event_type", "p", "n", ((F.col("below") <= target + slack) & (F.col("upto") >= target - slack)).alias("within_bound"))


@register("raw_files")
def raw_files(spark, sf_dir):
    """Documents written as raw files and scanned as binary files: files, bytes and lines per folder."""
    from tessera.sources.tables import binary_file_scan, table
    folder = scratch_path(spark, "raw")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs.select((F.col("doc_id") % 16).alias("part"), F.col("text")).where(F.col("text").isNotNull()).write.partitionBy("part").option("lineSep", "\u0001").text(folder)
    files = binary_file_scan(spark, folder, "*.txt")
    ends = F.length("content") - F.length(F.replace(F.col("content").cast("string"), F.lit("\u0001"), F.lit("")).cast("binary"))
    return files.groupBy(F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint").alias("part")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.sum(ends).cast("bigint").alias("n_docs"), (F.sum(F.length("sha256")) == F.count(F.lit(1)) * 64).alias("hashed"))
