"""Corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

Toxic documents go, one document of each group of near copies stays, repeated passages are
cut out of the texts, documents with benchmark windows go, and the rest is mixed by source
weight. Every stage but the last returns the columns of ``documents``; the last returns a
row per document with its copies in the mix. Stages are written to the shared scratch
folder and read again, so a lost executor repeats one stage's tasks at most.
"""

from shoalkit.llm import decontaminate, mixing, shingle_join, suffix_dedup, toxicity
from shoalkit.llm.common import stored, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("ngram_jaccard_join", shingle_join.stage),
    ("suffix_array_dedup", suffix_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned scores and suffix sorting are beyond SQL; tests/llm holds stages against brute force.
ORACLE_SQL = None
