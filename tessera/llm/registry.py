"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from tessera.llm import (best_fit_packing, bottom_k, collocations, exact_dedup, html_text, jaccard_join, language_id, line_templates,
                         periodic_runs, quality_rules, secret_scan, source_mixing, token_file)
from tessera.llm.common import documents
from tessera.session import scratch_path
from tessera.sources.tables import table


def op1_quality_rules(spark, sf_dir):
    return quality_rules.quality(documents(spark, sf_dir)).drop("rejected_by")


def op2_source_mixing(spark, sf_dir):
    return source_mixing.mix(documents(spark, sf_dir), budget=source_mixing.WHOLE)


def op3_token_file(spark, sf_dir):
    path = scratch_path(spark, "token_file")
    token_file.write(documents(spark, sf_dir), path)
    return token_file.read_back(spark, path)


def op4_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    rows = docs.select("doc_id", "text", language_id.held_out().alias("held_out"))
    return language_id.predict(rows, language_id.learn_from_rest(docs), keep=("held_out",))


def op5_best_fit_packing(spark, sf_dir):
    return best_fit_packing.pack(documents(spark, sf_dir))


def op6_line_templates(spark, sf_dir):
    return line_templates.drop_recurring_lines(documents(spark, sf_dir), **line_templates.WHOLE_JOB).drop("n_long")


def op7_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op9_secret_scan(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return secret_scan.scan(docs, secret_scan.fit_detector(docs))


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir))


def op12_bottom_k(spark, sf_dir):
    return bottom_k.near_duplicates(documents(spark, sf_dir))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, sf_dir))))


QUERIES = {q.__name__: q for q in (
    op1_quality_rules, op2_source_mixing, op3_token_file, op4_language_id, op5_best_fit_packing, op6_line_templates, op7_html_text,
    op8_jaccard_join, op9_secret_scan, op10_exact_dedup, op11_collocations, op12_bottom_k, op13_periodic_runs,
)}

SQL = {"op1_quality_rules": quality_rules.SQL, "op8_jaccard_join": jaccard_join.SQL, "op10_exact_dedup": exact_dedup.SQL,
       "op11_collocations": collocations.SQL, "op12_bottom_k": bottom_k.SQL}
