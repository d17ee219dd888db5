"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratovox.llm import decontaminate, extraction, language_model, lines, neighbours, packing, quality, ranking, resampling, simhash, toxicity, vector_search, warc
from stratovox.llm.common import crc_bucket, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=3, radius=3)
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = language_model.train(docs.where(crc_bucket("doc_id", 10) != 0))
    return language_model.scored(docs, model).select(
        F.col("id").alias("doc_id"), (crc_bucket("id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    hit = F.col("n_hit")
    return found.withColumnRenamed("id", "doc_id").withColumn("contaminated", (hit > 0) & (20 * hit >= F.col("n_words")))


def op4_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), limit=4096, end_id=1)
    return found.withColumnRenamed("id", "doc_id").withColumnRenamed("crc", "ids_crc32")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return found.select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to"
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = neighbours.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicated(docs, similarity=0.8, counts=("n_lines", "n_removed"), radius=None)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", folds=5)
    found = toxicity.scored(docs.select("doc_id", "text"), machine)
    return found.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=5)
    found = quality.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranking.build(table(spark, sf_dir, "documents"))
    found = ranking.search(index, table(spark, sf_dir, "benchmark"), k=20)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, name = resampling.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=["doc_id"], ngrams=1, buckets=10_000, min_words=20, percent=10, seed="2024",
    )
    return found.select("doc_id", *(F.col(name)[c].alias(c) for c in ("n_features", "weight", "score", "rank")))


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = vector_search.search(vector_search.build(vectors, scale=256), vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {"op1_simhash": op1_simhash, "op2_language_model": op2_language_model, "op3_decontaminate": op3_decontaminate, "op4_extract": op4_extract, "op5_pack": op5_pack, "op6_warc": op6_warc, "op7_neighbours": op7_neighbours, "op8_lines": op8_lines, "op9_toxicity": op9_toxicity, "op10_quality": op10_quality,
           "op11_ranking": op11_ranking, "op12_resampling": op12_resampling, "op13_vector_search": op13_vector_search}

_WORDS = "list_filter(string_split_regex(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

ORACLE_SQL: dict[str, str] = {
    "op11_ranking": f"""
        with d as (select row_number() over () as rid, doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
        g as (select count(*) filter (len(w) > 0) as n_docs, coalesce(sum(len(w)), 0)::bigint as n_words from d),
        i as (select row_number() over () as q, item_id, coalesce({_WORDS.format("text")}, []) as w from benchmark),
        qt as (select q, item_id, t, count(*) as n from (select q, item_id, unnest(w) as t from i) group by all),
        tf as (select rid, t, count(*) as tf from (select rid, unnest(w) as t from d) where t in (select t from qt) group by all),
        df as (select t, count(*) as df from tf group by t),
        wt as (select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w from df, g),
        m as (select rid, doc_id, 75 + (25 * len(w) * n_docs) // n_words as m from d, g where len(w) > 0),
        s as (select q, item_id, rid, doc_id, sum(n * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
              from qt join wt using (t) join tf using (t) join m using (rid) group by all),
        r as (select *, row_number() over (partition by q order by score desc, doc_id nulls last) as k from s where score > 0)
        select item_id, k::integer as rank, doc_id, score from r where k <= 20
    """,
    "op12_resampling": f"""
        with c as (select list_transform(range(0, 256), lambda b: list_reduce(list_prepend(b::bigint, range(0, 8)), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as tab),
        d as (select row_number() over () as rid, doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
        b as (select unnest({_WORDS.format("text")}) as f from benchmark), a as (select rid, unnest(w) as f from d),
        h as (select f, hex(encode(f)) as x from (select f from a union select f from b)),
        k as (select f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 1 + 2 * i::integer, 2))::bigint)),
                lambda y, v: xor(tab[1 + (xor(y, v) & 255)], y >> 8)), 4294967295) % 10000 as bucket from h, c),
        s as (select bucket, count(*) as s from a join k using (f) group by bucket), t as (select bucket, count(*) as t from b join k using (f) group by bucket),
        n as (select (select coalesce(sum(s), 0) from s) as ss, (select coalesce(sum(t), 0) from t) as tt),
        g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (ss + 10000)::double / ((coalesce(s, 0) + 1)::double * (tt + 10000)::double)))::bigint as gain
              from s full join t using (bucket), n),
        m as (select rid, count(*) as n, sum(gain)::bigint as total from a join k using (f) join g using (bucket) group by rid),
        e as (select d.rid, doc_id, len(w) as n_features, case when n > 0 then (total - ((total % n) + n) % n) // n else 0 end as weight,
                     ('0x' || substr(sha256(concat('2024:', doc_id)), 1, 8))::bigint as h from d left join m using (rid)),
        f as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from e),
        o as (select *, n_features >= 20 as open, count(*) filter (n_features >= 20) over () as total,
                     row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last) as r from f)
        select doc_id, n_features, weight, score, case when open and r <= (10 * total) // 100 then r end as rank from o
    """,
    "op13_vector_search": """
        with v as (select row_number() over () as rid, vec_id, list_transform(embedding::double[], lambda x: floor(256 * x)) as v from embeddings
                   where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        p as (select a.rid, a.vec_id as query_id, b.vec_id, list_inner_product(a.v, b.v)::bigint as score from v a join v b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 50 = 0),
        r as (select *, row_number() over (partition by rid order by score desc, vec_id) as k from p)
        select query_id, k::integer as rank, vec_id, score from r where k <= 5
    """,
    "op7_neighbours": """
        with recursive v as (select vec_id, label, embedding::double[] as e from embeddings),
        link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
                 and list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(node, low) as (select vec_id, vec_id from v union select b, low from reach join link on a = node where low < b),
        c as (select node, min(low) as component_id from reach group by node), n as (select a, count(*) as n from link group by a)
        select node as vec_id, coalesce(n, 0) as n_links, component_id, node = component_id as kept from c left join n on a = node
    """,
    "op6_warc": """
        with p as (select page_id, encode(coalesce(html, '')) as b from pages),
        h as (select page_id, octet_length(b) as payload_bytes, sha1(b) as hex, max(page_id) over (partition by b) as keep from p),
        d as (select *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + cast((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31 as integer), 1)), '') as payload_digest from h)
        select page_id, payload_bytes, payload_digest, case when page_id = keep then 'response' else 'revisit' end as record_type,
               case when page_id <> keep then keep end as refers_to from d
    """,
    "op3_decontaminate": f"""
        with d as (select row_number() over () as rid, doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
        b as (select item_id, {_WORDS.format("text")} as w from benchmark),
        win as (select distinct item_id, least(13, len(w)) as n, array_to_string(list_slice(w, s, s + least(13, len(w)) - 1), ' ') as g
                from b, unnest(range(1, len(w) - least(13, len(w)) + 2)) as t(s) where len(w) > 0),
        sizes as (select distinct n from win),
        dw as (select rid, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') as g
               from d, sizes, unnest(range(1, len(w) - n + 2)) as t(s) where len(w) >= n),
        hit as (select rid, s, win.n, item_id from dw join win on dw.g = win.g and dw.n = win.n),
        pos as (select rid, count(distinct p) as n_hit from hit, unnest(range(s, s + n)) as t(p) group by rid),
        its as (select rid, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
                from hit group by rid)
        select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
        from d left join pos using (rid) left join its using (rid)
    """,
}
