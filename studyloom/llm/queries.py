"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir)."""

    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_cost_balanced_packing")
def cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.packing import pack_texts

    pieces = pack_texts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.drop("ids")


#: DuckDB has no ASCII-only lower; its translate does the same as Spark's.
EXACT_DEDUP_SQL = """
with rows as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents),
groups as (
  select text_sha256, max(doc_id) as keep_id, count(*) as group_size from rows group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from rows join groups using (text_sha256)
"""


@query("op4_digest_index_dedup", EXACT_DEDUP_SQL)
def digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.exact_dedup import DigestIndex, deduplicate

    return deduplicate(table(spark, sf_dir, "documents"), DigestIndex(spark))


@query("op5_sainte_lague_mix")
def sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), weights=[3, 1, 2], share=1.5, most=2.0).drop(
        "source")


@query("op7_elias_fano_store")
def elias_fano_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.token_files import document_digests, write_store

    path = write_store(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return document_digests(spark, path)


@query("op9_heap_token_counts")
def heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op6_hyperminhash_near_dedup")
def hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), threshold=75, size=5)


TOP_K_SQL = """
with whole as (
  select vec_id, [cast(floor(64 * x::double) as bigint) for x in embedding] as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len([1 for x in embedding if x is null or not isfinite(x::double)]) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) as bigint) as score
  from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
  from scored) where rank <= 20
"""


@query("op2_branch_and_bound_top_k", TOP_K_SQL)
def branch_and_bound_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from studyloom.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@query("op8_marginal_unigram_language")
def marginal_unigram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op10_suffix_automaton_dedup")
def suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), span=50).drop("removed")


BACKOFF_SQL = r"""
with texts as (
  select doc_id, row_number() over () as d, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
words as (select d, unnest(w) as w3, unnest(range(1, len(w) + 1)) as i from texts),
grams as (
  select d, i, w3, case when i > 1 then lag(w3) over (partition by d order by i) || ' ' || w3 end as g2,
         case when i > 2 then lag(w3, 2) over (partition by d order by i) || ' '
              || lag(w3) over (partition by d order by i) || ' ' || w3 end as g3 from words),
own1 as (select d, w3 as g, count(*) as n from grams group by all),
own2 as (select d, g2 as g, count(*) as n from grams where g2 is not null group by all),
own3 as (select d, g3 as g, count(*) as n from grams where g3 is not null group by all),
left1 as (select d, g, sum(n) over (partition by g) - n as c from own1),
left2 as (select d, g, sum(n) over (partition by g) - n as c from own2),
left3 as (select d, g, sum(n) over (partition by g) - n as c from own3),
size as (select d, len(w) as n, (select sum(len(w)) from texts) as total from texts),
counted as (
  select x.d, x.i, a.c as c1, b.c as c2, e.c as c3, lag(a.c) over o as h1, lag(b.c) over o as h2,
         greatest(s.total - s.n, 1) as rest
  from grams x join size s on s.d = x.d join left1 a on a.d = x.d and a.g = x.w3
  left join left2 b on b.d = x.d and b.g = x.g2 left join left3 e on e.d = x.d and e.g = x.g3
  window o as (partition by x.d order by x.i)),
one as (select *, (case when c1 > 0 then c1 else 0.5 end) / rest::double as s1 from counted),
two as (select *, case when i = 1 then s1 when c2 > 0 then c2 / h1::double else 0.4 * s1 end as s2
        from one),
three as (select *, case when i < 3 then s2 when c3 > 0 then c3 / h2::double else 0.4 * s2 end as s3
          from two),
summed as (select d, sum(ln(s3)) as score, count(*) filter (where i > 2 and c3 = 0) as backed
           from three group by d)
select t.doc_id, cast(len(t.w) as bigint) as n_words,
       cast(coalesce(m.backed, 0) as bigint) as n_backed_off,
       round(coalesce(m.score, 0), 3) as log_score,
       round(m.score / len(t.w), 6) as mean_log_score
from texts t left join summed m on m.d = t.d
"""


@query("op1_stupid_backoff_scores", BACKOFF_SQL)
def stupid_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from studyloom.llm.backoff import score_documents

    scores = score_documents(table(spark, sf_dir, "documents"), order=3, alpha=0.4)
    return scores.select(
        "doc_id", "n_words", "n_backed_off", F.round("log_score", 3).alias("log_score"),
        F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6))
        .alias("mean_log_score"))


@query("op13_backtracking_piece_codec")
def backtracking_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from studyloom.llm.piece_codec import encode_and_decode

    coded = encode_and_decode(table(spark, sf_dir, "documents"),
                              vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_streamed_conversation_repair")
def streamed_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from studyloom.llm.conversations import damage, repair_reports

    return repair_reports(damage(table(spark, sf_dir, "conversations")), F.col("here"))


@query("op11_count_tree_spelling")
def count_tree_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from studyloom.llm.spelling import planted_words, spelling_forms

    return spelling_forms(planted_words(table(spark, sf_dir, "documents")))
