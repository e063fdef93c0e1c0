"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from linkwright.llm import class_lm, decontaminate, license_scan, near_dups, packing, quality_classifier, quality_rules, sharding, toxicity, url_filter

QUERIES = {
    "op1_chosen_path": near_dups.op1_chosen_path,
    "op6_class_ngrams": class_lm.op6_class_ngrams,
    "op4_classifier_chain": toxicity.op4_classifier_chain,
    "op7_quadratic_discriminant": quality_classifier.op7_quadratic_discriminant,
    "op3_template_windows": decontaminate.op3_template_windows,
    "op2_license_dice": license_scan.op2_license_dice,
    "op5_length_buckets": packing.op5_length_buckets,
    "op10_host_graph": url_filter.op10_host_graph,
    "op8_adaptive_rules": quality_rules.op8_adaptive_rules,
    "op9_byte_shards": sharding.op9_byte_shards,
}

SQL = {
    "op2_license_dice": license_scan.OP2_SQL,
    "op10_host_graph": url_filter.OP10_SQL,
    "op1_chosen_path": near_dups.OP1_SQL,
    "op8_adaptive_rules": quality_rules.OP8_SQL,
    "op9_byte_shards": sharding.OP9_SQL,
}
