"""Streaming clean-up and dense-vector similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.operators import skew, vectors
from corpuslens.operators.generate import body_model
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query, r6
from corpuslens.session import scratch_dir
from corpuslens.sources.tables import read_table, stream_path
from corpuslens.streaming.clean_stream import start_clean_stream
from corpuslens.streaming.generate_stream import start_generate_stream, start_keyed_generate_stream

TOP_K = 10
FIRST_DELIVERY = "en"
COS_DIGITS = 9


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


@query("stream_clean",
       "with " + q.preprocess_ctes("documents", "doc_id", "text")
       + f" select d.doc_id, pp_f.cleaned, {q.remove_brackets(q.remove_cutoff('d.text'))} as post "
       "from documents d join pp_f using (doc_id)")
def q_stream_clean(spark, sf_dir):
    """Stream the documents file through the cleaning job into Parquet."""
    schema = read_table(spark, sf_dir, "documents").schema
    base = scratch_dir(spark, "stream-clean")
    query_ = start_clean_stream(spark, stream_path(sf_dir, "documents"), schema, base + "/sink", base + "/checkpoint",
                                file_glob="*")
    query_.awaitTermination()
    return spark.read.schema(T.StructType([schema["doc_id"], *_strings("cleaned", "post")])).parquet(base + "/sink")


@query("stream_generate", f"select doc_id, {q.all_sentences(q.body('text'))} as summary from documents")
def q_stream_generate(spark, sf_dir):
    """Generate over the documents file as a stream; a rerun adds nothing."""
    schema = read_table(spark, sf_dir, "documents").schema
    base = scratch_dir(spark, "stream-generate")
    for _ in range(2):  # the second start finds every file committed
        start_generate_stream(spark, stream_path(sf_dir, "documents"), schema, base + "/sink", base + "/checkpoint",
                              body_model(), file_glob="*").awaitTermination()
    return spark.read.schema(T.StructType([schema["doc_id"], *_strings("summary")])).parquet(base + "/sink")


@query("stream_generate_keyed",
       f"select doc_id, {q.all_sentences(q.body('text'))} as summary, "
       f"case when lang = '{FIRST_DELIVERY}' then 1 else 2 end as delivery from documents")
def q_stream_generate_keyed(spark, sf_dir):
    """One dataset is delivered and generated, then all documents come in new
    files: after the restart only keys not seen before are generated."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    base = scratch_dir(spark, "stream-keyed")
    for delivery, rows in enumerate([docs.where(F.col("lang") == FIRST_DELIVERY), docs], 1):
        sent = rows.select("doc_id", "text", F.lit(delivery).alias("delivery"))
        sent.write.parquet(f"{base}/source/delivery-{delivery}")
        start_keyed_generate_stream(spark, base + "/source", sent.schema, base + "/sink", base + "/checkpoint",
                                    body_model(), carry=["delivery"]).awaitTermination()
    return spark.read.parquet(base + "/sink").select("doc_id", "summary", "delivery")


@query("embedding_cosine_topk",
       "with ex as (select vec_id, label, unnest(embedding) as v, unnest(range(1, len(embedding) + 1)) as i "
       "from embeddings), "
       "cen as (select label, i, avg(cast(v as double)) as c from ex group by label, i), "
       "dots as (select ex.vec_id, ex.label, sum(cast(ex.v as double) * cen.c) as dot, "
       "sqrt(sum(cast(ex.v as double) * cast(ex.v as double))) as nv, sqrt(sum(cen.c * cen.c)) as nc "
       "from ex join cen using (label, i) group by ex.vec_id, ex.label), "
       "cs as (select vec_id, label, case when nv > 0 and nc > 0 then dot / (nv * nc) end as cosine from dots), "
       f"rk as (select *, row_number() over (partition by label order by round(cosine, {COS_DIGITS}) desc nulls last, "
       f"vec_id) as rank from cs) "
       f"select label, cast(rank as integer) as rank, vec_id, {q.r6('cosine')} as cosine from rk "
       f"where rank <= {TOP_K}")
def q_embedding_cosine_topk(spark, sf_dir):
    """Vectors closest to their label's mean vector, top k per label.

    The centroid join and the ranking are salted by vector id, so a label
    holding most of the vectors is still spread over many tasks.
    """
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    cents = vectors.group_centroids(emb, "label", "embedding")
    salt = F.xxhash64("vec_id")
    salts = skew.salts_for(emb, ["label"])
    joined = skew.salted_join(emb, cents, ["label"], salt, salts)
    scored = joined.select("vec_id", "label", vectors.dense_cosine("embedding", "centroid").alias("cosine"))
    order = [F.round("cosine", COS_DIGITS).desc_nulls_last(), F.col("vec_id").asc()]
    top = skew.top_k_per_group(scored, ["label"], order, TOP_K, salt, salts)
    return top.select("label", F.col("rank").cast("int").alias("rank"), "vec_id", r6("cosine").alias("cosine"))
