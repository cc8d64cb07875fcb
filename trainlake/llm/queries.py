"""One registered query per operator, over its whole table, and SQL where it can tell the same."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.llm import bpe, counts, jaccard, lexical, mixing, negatives, packing, pii, substring, toxicity, vectors, warc
from trainlake.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.section_counts(table(spark, sf_dir, "documents"))


def op3_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_groups(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.best_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.kept_digests(table(spark, sf_dir, "documents"))


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record, against a replica in which some records rotted and some volumes were cut off."""
    bodies = warc.records(table(spark, sf_dir, "pages"))
    rotten = F.when(F.col("record_id") % 97 == 5, F.translate("body", "e", "E")).otherwise(F.col("body"))
    cut_off = (F.col("volume") % 3 == 1) & (F.col("record_id") % warc.VOLUME >= 900)
    replica = bodies.where(F.coalesce(~cut_off, F.lit(True))).withColumn("body", rotten)
    return warc.audit(warc.manifest(bodies), warc.manifest(replica))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row counts as of the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "times")


QUERIES = {q.__name__: q for q in (op1_bpe, op2_token_counts, op3_ann_tree, op4_packing, op5_pii, op6_ngram_jaccard, op7_toxicity, op8_exact_topk, op9_substring_dedup, op10_warc_fixity, op11_lexical, op12_hard_negatives, op13_mixing)}

_OP8 = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x
           from embeddings where embedding is not null),
s as (select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) as bigint) as score
      from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

_WORDS = r"""w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents)"""

_OP9 = f"""
with {_WORDS},
g as (select doc_id, unnest(range(1, len(words) - 18)) as pos, words from w where len(words) >= 20),
k as (select doc_id, pos, md5(array_to_string(words[pos:pos + 19], ' ')) as k from g),
l as (select doc_id, pos, row_number() over (partition by k order by doc_id, pos) > 1 as later from k),
gone as (select distinct doc_id, unnest(range(pos, pos + 20)) as pos from l where later),
e as (select doc_id, unnest(range(1, len(words) + 1)) as pos, unnest(words) as word from w where len(words) > 0),
t as (select e.doc_id, count(gone.pos) as n_removed, string_agg(word, ' ' order by e.pos) filter (where gone.pos is null) as kept
      from e left join gone on e.doc_id = gone.doc_id and e.pos = gone.pos group by e.doc_id)
select w.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join t on w.doc_id = t.doc_id
"""

_OP6 = f"""
with recursive {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
g as (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as pos from w where len(words) > 0),
t as (select distinct doc_id, md5(array_to_string(words[pos:pos + 4], ' ')) as t from g),
n as (select doc_id, count(*) as n from t group by doc_id),
met as (select a.doc_id as a, b.doc_id as b, count(*) as m from t a join t b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2),
link as (select a, b from met join n x on a = x.doc_id join n y on b = y.doc_id where 100 * m >= 75 * (x.n + y.n - m)),
reach(a, b) as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, cast(least(w.doc_id, coalesce(min(reach.b), w.doc_id)) as bigint) as component_id
from w left join n on w.doc_id = n.doc_id left join reach on w.doc_id = reach.a group by w.doc_id, n.n
"""

_OP10 = r"""
with p as (select page_id, page_id // 1000 as volume,
             'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
             || case when url is null then '' else 'WARC-Target-URI: ' || url || chr(13) || chr(10) end
             || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10)
             || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as body from pages),
l as (select *, cast(octet_length(encode(body)) as bigint) as length from p),
o as (select *, cast(coalesce(sum(length) over (partition by volume order by page_id rows between unbounded preceding and 1 preceding), 0) as bigint) as pos from l),
s as (select *, case when volume % 3 = 1 and page_id % 1000 >= 900 then 'missing' when page_id % 97 = 5 and contains(body, 'e') then 'corrupt' end as state from o)
select cast(volume as bigint) as volume, page_id as record_id, 0 as copy, pos as "offset", length, state from s where state is not null
"""

_OP12 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x
           from embeddings where embedding is not null and label is not null),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) as bigint) as score
      from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as integer) as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s on p.anchor_id = s.anchor_id and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 10
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP11 = f"""
with d as (select doc_id, {_TERMS} as terms from documents where text is not null),
s as (select cast(count(*) as bigint) as big_n, cast(sum(len(terms)) as bigint) as big_l from d where len(terms) > 0),
p as (select doc_id, n, term, cast(count(*) as bigint) as tf from (select doc_id, cast(len(terms) as bigint) as n, unnest(terms) as term from d) group by doc_id, n, term),
f as (select term, count(*) as df from p group by term),
q as (select item_id, term, count(*) as repeats from (select item_id, unnest({_TERMS}) as term from benchmark) group by item_id, term),
w as (select item_id, q.term, repeats * cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) as bigint) as w from q join f on q.term = f.term, s),
x as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) as bigint) as score
      from w join p on w.term = p.term, s group by item_id, doc_id),
r as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from x where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10
"""

ORACLES: dict[str, str] = {"op11_lexical": _OP11, "op12_hard_negatives": _OP12, "op6_ngram_jaccard": _OP6, "op8_exact_topk": _OP8, "op9_substring_dedup": _OP9, "op10_warc_fixity": _OP10}
