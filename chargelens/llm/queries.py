"""The registered queries of the corpus operators and their SQL."""

from . import (decontaminate, host_quality, language_id, minhash, mixing, periodic_runs, personal_data, search, secrets,
               sharding, suffix_dedup, toxicity, url_rules)
from .common import read


def _documents(fn, *others):
    return lambda spark, sf_dir: fn(read(spark, sf_dir, "documents"), *[read(spark, sf_dir, t) for t in others])


def queries():
    return {
        "op1_sharding": _documents(sharding.shard_documents),
        "op2_mixing": _documents(mixing.mix_documents),
        "op3_toxicity": _documents(toxicity.score_documents, "labels"),
        "op4_host_quality": _documents(host_quality.judge_documents),
        "op5_url_rules": lambda spark, sf_dir: url_rules.judge(read(spark, sf_dir, "pages")),
        "op6_language_id": _documents(language_id.identify_documents),
        "op7_minhash": _documents(minhash.link_documents),
        "op8_decontamination": _documents(decontaminate.contaminated, "benchmark"),
        "op9_suffix_dedup": _documents(suffix_dedup.repeat_documents),
        "op10_secrets": _documents(secrets.scan_documents),
        "op11_personal_data": _documents(personal_data.detect_documents),
        "op12_search": _documents(search.search_documents, "benchmark"),
        "op13_periodic_runs": _documents(periodic_runs.run_documents),
    }


def oracle_sql():
    return {"op5_url_rules": url_rules.oracle_sql(), "op12_search": search.oracle_sql(),
            "op13_periodic_runs": periodic_runs.oracle_sql()}
