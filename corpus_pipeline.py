"""A training corpus from `documents` in five stages.

Each stage takes (spark, docs, sf_dir), is written as parquet and read again as the docs of the next.
"""

from chargelens.llm import decontaminate, minhash, mixing, sharding, toxicity
from chargelens.llm.common import materialize, read

SHARDS = 16


def clean(spark, docs, sf_dir):
    """Documents not predicted toxic; learned from all rows of `labels`."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def distinct(spark, docs, sf_dir):
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs)


def unseen(spark, docs, sf_dir):
    """Documents in which no item of `benchmark` is found."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix of the sources takes them."""
    return mixing.repeat_rows(docs)


def sharded(spark, docs, sf_dir):
    """doc_id, source, size, checksum and place of every row of the mix in SHARDS shards."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [("toxicity", clean), ("near_duplicates", distinct), ("decontamination", unseen), ("mixing", mixed),
          ("sharding", sharded)]

#: The first two stages cannot be said in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
