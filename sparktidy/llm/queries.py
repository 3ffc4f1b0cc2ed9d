"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktidy.llm import pieces, quality, toxicity
from sparktidy.llm._frames import bounded, fold_of
from sparktidy.llm.decontaminate import find_leaks
from sparktidy.llm.html_text import extract_text
from sparktidy.llm.licenses import scan_licenses
from sparktidy.llm.line_dedup import drop_repeated_blocks
from sparktidy.llm.near_dup import near_classes
from sparktidy.llm.prefix_trie import number_turns, prefix_trie
from sparktidy.llm.repeats import remove_repeats
from sparktidy.llm.spelling import spelling_groups, word_counts
from sparktidy.llm.topk import top_inner_products
from sparktidy.llm.url_filter import Rule, filter_urls
from sparktidy.workspace import stage

URL_RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def toxic_training() -> Column:
    """The rows from which labels of toxicity are learnt."""
    return fold_of("doc_id", 5) != 0


PIECES = "/opt/tokenizers/piece_bpe_32k.model"  # read by the driver


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), "doc_id")
    n_bytes = F.octet_length("kept").cast("bigint") + F.col("n_removed")
    return kept.select("doc_id", n_bytes.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_spans") > 0).alias("has_repeat"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold_of("doc_id", 3) == 1
    described = stage(quality.describe(table(spark, sf_dir, "documents"), "text", ["doc_id"]), "quality-features")
    model = quality.train(quality.training_features(described, table(spark, sf_dir, "labels"), "quality", ~held_out), "quality")
    scored = quality.score_quality(described, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class and how many documents the class holds."""
    classes = stage(near_classes(table(spark, sf_dir, "documents"), "doc_id").toDF("doc_id", "class_id"), "near-classes")
    sizes = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    return classes.join(sizes, "class_id").select("doc_id", "class_id", "class_size")


def piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding gives the text back."""
    coded = pieces.encode(table(spark, sf_dir, "documents"), pieces.load_model(PIECES), keep=["doc_id"], check=True)
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels"), "toxic", toxic_training()))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (~toxic_training()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what was cut, and the digest of the text that stays."""
    docs = drop_repeated_blocks(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    cut = F.coalesce(F.aggregate("__runs", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["begin"]), F.lit(0))
    return docs.select("doc_id", cut.alias("n_removed_lines"), F.coalesce(F.size("__runs"), F.lit(0)).alias("n_blocks"), F.length("text").alias("n_kept_chars"), F.md5("text").alias("kept_md5"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, one code point gone from some by the contract, with their forms."""
    counted = word_counts(table(spark, sf_dir, "documents"), least=5, delete_by="doc_id", every=97).filter("n >= 3")
    return spelling_groups(counted)


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations: each begins with some turns of its hundred's first."""
    turns = stage(number_turns(table(spark, sf_dir, "conversations")), "turns")
    base = F.col("conv") - F.col("conv") % 100
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    sizes = stage(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "conversations")
    lent = sizes.filter("conv % 100 = 0").select(F.col("conv").alias("base"), F.least("n", F.lit(5)).alias("lent"))
    own = turns.filter(F.col("at") >= taken).withColumn("base", base).join(bounded(lent), "base", "left")
    own = own.withColumn("at", F.col("at") - taken + F.least(taken, F.coalesce("lent", F.lit(0)))).select(*turns.columns)
    # a lender has at most a hundred borrowers of five turns
    lenders = turns.filter("conv % 100 = 0 and at < 5").withColumnRenamed("conv", "base")
    borrowed = sizes.select("conv", base.alias("base")).join(lenders, "base").filter(F.col("at") < taken).select(*turns.columns)
    rebuilt = stage(own.unionByName(borrowed), "rebuilt")
    nodes = prefix_trie(rebuilt, sizes.select("conv"))
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": url_verdicts,
    "op2_suffix_array_dedup": repeated_strings,
    "op3_benchmark_decontamination": benchmark_leaks,
    "op4_quality_classifier": quality_scores,
    "op5_minhash_near_dedup": near_duplicates,
    "op6_sentencepiece": piece_ids,
    "op7_toxicity": toxicity_scores,
    "op8_license_scans": license_passages,
    "op9_line_dedup": line_dedup,
    "op10_exact_topk": nearest_vectors,
    "op11_spelling_variants": spelling_forms,
    "op12_html_extraction": page_texts,
    "op13_conversation_trie": conversation_trie,
}

# By the definition alone, without masks: 13 equal words of 16 hold four equal neighbours, so words four by
# four place item and document on a diagonal.
LEAKS_SQL = r"""
with d as (select distinct doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') w from documents),
b as (select distinct item_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') w from benchmark),
dp as (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1)::bigint)) i from d),
bp as (select item_id, w, unnest(range(1, (len(w) - 2)::bigint)) j from b where len(w) >= 5),
dq as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] g from dp),
bq as (select item_id, j, w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] || ' ' || w[j + 3] g from bp),
diag as (select distinct doc_id, item_id, i - j g from dq join bq using (g)),
eq as (select diag.doc_id, diag.item_id, diag.g, len(b.w) n, least(len(b.w), 16) l,
  list_transform(range(1, (len(b.w) + 1)::bigint), lambda j: case when j + diag.g >= 1 and j + diag.g <= len(d.w) and d.w[greatest(j + diag.g, 1)] = b.w[j] then 1 else 0 end) e
  from diag join d on d.doc_id = diag.doc_id join b on b.item_id = diag.item_id),
win as (select doc_id, item_id, g, n, l, e, unnest(range(0, (n - l + 1)::bigint)) s from eq),
sums as (select doc_id, item_id, n, l, s + g begin_at, list_sum(e[s + 1 : s + l])::int matched from win)
select doc_id, item_id, max(n)::int item_words, max(matched)::int matched, max(l)::int as "window",
  arg_min(begin_at, (-matched, begin_at))::int as "begin"
from sums where matched >= case when n < 16 then n else 13 end group by doc_id, item_id
"""

# crc32 by its table; `crc` folds a list of bytes `l`
CRC_SQL = """
crc_table as (select list_transform(range(256), lambda x: list_reduce(range(8), lambda a, b: case when a % 2 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end, x::bigint)) t)
"""


def crc_sql(byte_list: str) -> str:
    return f"xor(list_reduce({byte_list}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"


TRIE_SQL = f"""
with {CRC_SQL},
turns as (select conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) m, length(coalesce(text, ''))::bigint chars,
  row_number() over (partition by conv_id order by turn nulls first, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) i
  from conversations where conv_id is not null),
lists as (select conv_id, list(m order by i) ms, list(chars order by i) cs from turns group by conv_id),
h as (select conv_id, {crc_sql("list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::bigint)")} % 6 h from lists, crc_table),
rebuilt as (select l.conv_id, coalesce(d.ms[1 : h.h], []) || l.ms[h.h + 1 :] ms, coalesce(d.cs[1 : h.h], []) || l.cs[h.h + 1 :] cs
  from lists l join h using (conv_id) left join lists d on d.conv_id = l.conv_id - l.conv_id % 100),
steps as (select conv_id, ms, cs, unnest(range(0, (len(ms) + 1)::bigint)) d from rebuilt),
paths as (select conv_id, d, md5(array_to_string(ms[1 : d], ',')) k, case when d > 0 then md5(array_to_string(ms[1 : d - 1], ',')) end up,
  case when d > 0 then cs[d] else 0 end chars, d = len(ms) ends from steps),
nodes as (select d, k, any_value(up) up, min(conv_id) c, count(*) n, any_value(chars) chars, coalesce(string_agg(case when ends then conv_id::varchar end, ',' order by conv_id), '') ends from paths group by d, k),
kids as (select d - 1 d, up k, count(*) kids from nodes where d > 0 group by all),
tree as (select nodes.*, coalesce(kids, 0) kids from nodes left join kids using (d, k)),
below as (select p.d, p.k, sum((u.n - 1) * u.chars)::bigint saved, sum((u.kids = 0)::int)::bigint leaves from tree u join paths p on p.conv_id = u.c and p.d <= u.d group by all)
select t.c conv_id, t.d::bigint depth, p.c parent_conv_id, t.n n_convs, t.kids n_children, b.leaves n_leaves, b.saved saved_tokens, sha256(t.ends) ends_sha256
from tree t join below b using (d, k) left join tree p on p.d = t.d - 1 and p.k = t.up
"""

SPELLING_SQL = f"""
with recursive {CRC_SQL},
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) run from documents),
by_doc as (select doc_id, run, count(*) n, coalesce(doc_id::varchar, '') || ':' || run s from runs where length(run) >= 5 group by all),
tagged as (select run, n, {crc_sql("list_transform(range(0, (strlen(s))::bigint), lambda i: ('0x' || substr(hex(s), (2 * i + 1)::bigint, 2))::bigint)")} h from by_doc, crc_table),
words as (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, n from tagged),
vocabulary as (select word, sum(n)::bigint n from words where length(word) >= 5 group by word having sum(n) >= 3),
cut as (select word, n, unnest(range(1, (length(word) + 1)::bigint)) i from vocabulary),
gaps as (select word, n, substr(word, 1, i - 1) l, substr(word, i + 1) r from cut),
pairs as (select a.word, b.word near, b.n from gaps a join gaps b using (l, r) where a.word <> b.word
  union select a.word, v.word, v.n from gaps a join vocabulary v on v.word = a.l || a.r
  union select v.word, a.word, a.n from gaps a join vocabulary v on v.word = a.l || a.r),
best as (select word, count(*) n_near, arg_min(near, (-n, encode(near))) form, max(n) form_n from pairs group by word),
formed as (select v.word, v.n, coalesce(n_near, 0) n_near, case when form_n >= 2 * v.n then form end form, case when form_n >= 2 * v.n then form_n end form_n from vocabulary v left join best using (word)),
way as (select word, word reached from formed union all select way.word, f.form from way join formed f on f.word = way.reached where f.form is not null),
ways as (select way.word, way.reached root from way join formed f on f.word = way.reached where f.form is null)
select f.word, f.form, w.root, f.n, f.n_near, f.form_n from formed f join ways w using (word)
"""

TOPK_SQL = """
with v as (select row_number() over () u, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) c from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = len(embedding)),
s as (select q.u, q.vec_id query_id, c.u cu, c.vec_id, list_sum(list_transform(range(1, (len(q.c) + 1)::bigint), lambda i: q.c[i] * c.c[i]))::bigint score
  from v q join v c on q.u <> c.u and len(q.c) = len(c.c) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by u order by score desc, vec_id, cu)::int rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

ORACLES: dict[str, str] = {"op10_exact_topk": TOPK_SQL, "op3_benchmark_decontamination": LEAKS_SQL, "op11_spelling_variants": SPELLING_SQL, "op13_conversation_trie": TRIE_SQL}
