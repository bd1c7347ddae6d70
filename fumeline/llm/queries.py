"""The operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fumeline.llm import alignment, anchors, decontaminate, forest, itq, lattice, mixing, quality, secrets, simhash, suffixes, toxicity, trie
from fumeline.llm.common import batches_of, remainder, table
from fumeline.llm.sql import oracle_sql  # noqa: F401


def op1_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, remainder("doc_id", 3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_itq(spark, sf_dir):
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


def op4_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_suffixes(spark, sf_dir):
    return suffixes.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_anchors(spark, sf_dir):
    return anchors.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_lattice(spark, sf_dir):
    scored = lattice.scores(table(spark, sf_dir, "documents"), remainder("doc_id", 5) != 1)
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op8_secrets(spark, sf_dir):
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.fit(docs, labels, "quality", remainder("doc_id", 5) != 0)
    return quality.score(docs, weights).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_trie(spark, sf_dir):
    return trie.nodes(table(spark, sf_dir, "conversations"))


def op12_forest(spark, sf_dir):
    return forest.neighbours(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark, sf_dir):
    return alignment.linked(table(spark, sf_dir, "documents"))


def queries():
    import corpus_pipeline

    found = {
        "op1_toxicity": op1_toxicity,
        "op2_itq": op2_itq,
        "op3_mixing": op3_mixing,
        "op4_simhash": op4_simhash,
        "op5_suffixes": op5_suffixes,
        "op6_anchors": op6_anchors,
        "op7_lattice": op7_lattice,
        "op8_secrets": op8_secrets,
        "op9_quality": op9_quality,
        "op10_decontaminate": op10_decontaminate,
        "op11_trie": op11_trie,
        "op12_forest": op12_forest,
        "op13_alignment": op13_alignment,
    }
    return {name: _modest(query) for name, query in found.items()} | {"pipeline": corpus_pipeline.run}


def _modest(query):
    def run(spark, sf_dir):
        # The lattice codes a batch's words by their own table; larger ones repeat fewer words.
        batches_of(spark, "32m" if query is op7_lattice else "8m")
        return query(spark, sf_dir)

    return run
