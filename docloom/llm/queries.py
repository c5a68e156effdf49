"""The queries opN_<name> of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import licenses, lines, media, ngram_join, periodic, pii, quality, repeats, resampling, sentencepiece_sampling, toxicity, vectors
from docloom.llm.common import table
from docloom.llm.packing import best_fit_pack


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_sampling.encoded_digest(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_links(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_deleted", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document become periodic from some place on; the id fixes which, where and how."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}


LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
GAP = r"\x20\x09-\x0D"
#: What links reach, from edges (x, y) of both directions over the ids of a table.
REACH = "reach(a, b) as (select {id}, {id} from {table} union select a, y from reach join edges on b = x)"


def jaccard_sql() -> str:
    n, least = ngram_join.SHINGLE, ngram_join.PERCENT
    return f"""with recursive words as (select doc_id, regexp_extract_all({LOW}, '[^{GAP}]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < {n} then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) end as s from words),
tokens as (select doc_id, len(s) as n, unnest(s) as t from sets),
pairs as (select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as c from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id group by all),
edges as (select x, y from pairs where 100 * c >= {least} * (nx + ny - c)),
{REACH.format(id='doc_id', table='documents')}
select s.doc_id, len(s)::bigint as n_shingles, component_id, coalesce(n_links, 0)::bigint as n_links from sets s join (select a, min(b) as component_id from reach group by a) r on a = s.doc_id left join (select x, count(*) as n_links from edges group by x) l on x = s.doc_id"""


def vectors_sql() -> str:
    return f"""with recursive good as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges as (select a.vec_id as x, b.vec_id as y from good a join good b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= {vectors.THRESHOLD}),
{REACH.format(id='vec_id', table='embeddings')}
select v.vec_id::bigint as vec_id, coalesce(n, 0)::bigint as n_links, component_id::bigint as component_id, component_id = v.vec_id as kept from embeddings v join (select a, min(b) as component_id from reach group by a) r on a = v.vec_id left join (select x, count(*) as n from edges group by x) l on x = v.vec_id"""


def lines_sql() -> str:
    """A run of more lines is a union of runs of at most MIN_WORDS lines, as each line has a word."""
    least = lines.MIN_WORDS
    return f"""with every as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as k from documents),
numbered as (select *, row_number() over (partition by doc_id order by k) as i, len(regexp_extract_all(line, '[^{GAP}]+')) as n from every where regexp_matches(line, '[^{GAP}]')),
ahead as (select doc_id, i, list(line) over f as held, list(n) over f as counts from numbered window f as (partition by doc_id order by i rows between current row and {least - 1} following)),
runs as (select doc_id, i, m, sha256(array_to_string(held[1:m], chr(10))) as name from (select *, unnest(range(1, len(held) + 1)) as m from ahead) where list_sum(counts[1:m]) >= {least}),
firsts as (select name, m, min({{'d': doc_id, 'i': i}}) as f from runs group by name, m having count(*) > 1),
gone as (select distinct doc_id, unnest(range(i, i + m)) as i from runs join firsts using (name, m) where doc_id <> f.d or i >= f.i + m),
marked as (select e.doc_id, e.k, e.line, n.i, g.i is not null as cut, lag(g.i) over (partition by e.doc_id order by n.i is null, n.i) as before from every e left join numbered n using (doc_id, k) left join gone g on g.doc_id = e.doc_id and g.i = n.i)
select doc_id, count(i)::bigint as n_lines, count(*) filter (cut)::bigint as n_deleted, count(*) filter (cut and before is null)::bigint as n_runs, sha256(coalesce(string_agg(line, chr(10) order by k) filter (not cut), '')) as kept_sha256 from marked group by doc_id"""


def licenses_sql() -> str:
    """Every line, and every window that begins at a template word, against every template."""
    word, quoted = licenses.WORD, lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    index = []
    for label, text in licenses.TEMPLATES:
        kinds = sorted(set(text.split()))
        index.append(f"('{label}', {quoted(kinds)}, {len(kinds)}, {max(1, math.ceil(licenses.THRESHOLD * len(kinds) - 1e-9))}, {math.ceil(len(text.split()) / licenses.THRESHOLD - 1e-9)})")
    phrases = ", ".join(f"('{label}', {quoted(words)})" for label, words in licenses.PHRASES.items())
    return f"""with texts as (select doc_id, {LOW} as low from documents),
words as (select doc_id, low, regexp_extract_all(low, '{word}') as w from texts),
places as (select doc_id, w, unnest(w) as token, generate_subscripts(w, 1) as i from words),
hits as (select doc_id, label, i - 1 as start from places join (values {phrases}) p(label, phrase) on token = phrase[1] and w[i:i + len(phrase) - 1] = phrase),
templates as (select * from (values {', '.join(index)}) t(label, kinds, n, need, width)),
shares as (select doc_id, label, need, n, len(list_intersect(kinds, w[i:i + width - 1])) as met from places join templates on list_contains(kinds, token)
 union all select doc_id, label, need, n, len(list_intersect(kinds, regexp_extract_all(line, '{word}'))) from (select doc_id, unnest(string_split(low, chr(10))) as line from texts) join templates on true),
found as (select doc_id, label, max(met / n) as share from shares where met >= need group by doc_id, label),
base as (select doc_id, count(*) as n_base, min(start) as first_word, max(start) as last_word, string_agg(distinct label, ',' order by label) as base_labels from hits group by doc_id),
labelled as (select doc_id, string_agg(distinct label, ',' order by label) as labels, max(share) as share from (select doc_id, label, share from found union all select doc_id, label, 1.0 from hits) group by doc_id)
select w.doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(share, 0)::double as score
from words w left join base using (doc_id) left join labelled using (doc_id)"""


def resampling_sql() -> str:
    """crc32 bit by bit over the distinct words; a bucket's sums, gains and the documents' weights as plain aggregates."""
    b, low = resampling.BUCKETS, LOW
    return f"""with words as (select doc_id, regexp_extract_all({low}, '{licenses.WORD}') as w from documents),
tokens as (select doc_id, unnest(w) as f from words),
aims as (select unnest(regexp_extract_all({low}, '{licenses.WORD}')) as f from benchmark),
kinds as (select f, hex(encode(f)) as x from (select f from tokens union select f from aims)),
steps as (select f, flatten(list_transform(range(1, len(x), 2), lambda i: [('0x' || x[i:i + 1])::bigint, 0, 0, 0, 0, 0, 0, 0])) as bits from kinds),
named as (select f, (xor(list_reduce(bits, lambda c, v: xor(xor(c, v) >> 1, 3988292384::bigint * (xor(c, v) & 1)), 4294967295::bigint), 4294967295::bigint) % {b})::int as bucket from steps),
source as (select bucket, count(*) as s from tokens join named using (f) group by bucket),
target as (select bucket, count(*) as t from aims join named using (f) group by bucket),
gains as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from tokens) + {b}) / ((coalesce(s, 0) + 1)::double * ((select count(*) from aims) + {b}))))::bigint as gain from source left join target using (bucket)),
weights as (select doc_id, sum(gain)::bigint as weight from tokens join named using (f) join gains using (bucket) group by doc_id),
scored as (select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight, coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || sha256('{resampling.SEED}:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as score from words left join weights using (doc_id)),
drawn as (select *, case when n_features >= {resampling.MIN_WORDS} then row_number() over (partition by n_features >= {resampling.MIN_WORDS} order by score desc, doc_id) end as place, {resampling.PERCENT} * count(*) filter (n_features >= {resampling.MIN_WORDS}) over () // 100 as wanted from scored)
select doc_id, n_features, weight, score, case when place <= wanted then place end::bigint as rank from drawn"""


def oracle_sql() -> dict[str, str]:
    return {"op12_importance_resampling": resampling_sql(), "op3_ngram_jaccard_join": jaccard_sql(), "op5_license_scans": licenses_sql(), "op8_line_dedup": lines_sql(), "op9_embedding_near_dedup": vectors_sql()}
