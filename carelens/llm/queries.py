"""The operators of this package applied to whole tables, by query name, and their SQL."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import languages, quality, toxicity
from carelens.llm import token_counts as tc
from carelens.llm.decontaminate import contamination
from carelens.llm.fingerprints import compare_with_next
from carelens.llm.jaccard_join import near_duplicates
from carelens.llm.joins import rows_of
from carelens.llm.lexical_search import LexicalSearch
from carelens.llm.mixing import equal_weights, mix
from carelens.llm.packing import Limits, Packing
from carelens.llm.sharding import shard
from carelens.llm.substring_dedup import repeated_passages
from carelens.llm.vector_codes import VectorCodes
from carelens.session import cut_lineage, shared_folder, tune

Query = Callable[[SparkSession, str], DataFrame]


@functools.cache
def _package() -> str:
    """This package as an archive that Spark sends to its workers."""
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="carelens-code-")) / "carelens.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, f"{root.name}/{file.relative_to(root)}")
    return str(path)


def ship(spark: SparkSession) -> SparkSession:
    """Let workers import this package, wherever they run; once for each Spark context."""
    if not any("carelens" in f for f in spark.sparkContext.listFiles):
        spark.sparkContext.addPyFile(_package())
    return tune(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a similarity of 0.9 or more."""
    return near_duplicates(read(ship(spark), sf_dir, "documents"), words=3, percent=90)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return compare_with_next(read(ship(spark), sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside a fifth of the ids."""
    docs = read(ship(spark), sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = languages.fit(languages.language_counts(docs.where(fold != 0)))
    return languages.identify(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "mixture")


WORDS = r"[^ \t\n\x0B\f\r]+"
PIECES = r"\p{L}+|\p{N}|[^ \t\n\x0B\f\r\p{L}\p{N}]+"
NOISE = r"[#$%&*|!]+"


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four commits: all documents come in under two tokenizer versions,
    those labelled toxic go out, those of quality 0 are counted again without runs of symbols,
    and the first batch is sent once more, which changes nothing."""
    docs, labels = (read(tune(spark), sf_dir, t) for t in ("documents", "labels"))
    counters = {"words-1": tc.pattern_counter(WORDS), "pieces-2": tc.pattern_counter(PIECES)}
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    poor = cut_lineage(labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti"))
    of = lambda rows, ids: rows.join(ids, "doc_id", "left_semi")
    old = cut_lineage(tc.count_documents(docs, counters))
    # Only what is revised is read and counted a second time.
    plain = rows_of(docs, poor.where("doc_id is not null")).withColumn("text", F.regexp_replace("text", NOISE, ""))
    new = tc.count_documents(plain, counters)
    rollup = tc.Rollup(spark, f"{shared_folder(spark)}/carelens-rollup-{uuid.uuid4().hex}")
    batches = {"load": tc.inserts(old), "takedown": tc.deletes(of(old, toxic)),
               "recount": tc.revisions(of(old, poor), new)}
    for name, changes in [*batches.items(), ("load", batches["load"])]:
        rollup.commit(name, changes)
    return rollup.totals(list(batches))


SQL4 = rf"""
with counted as (
  select doc_id, source, lang, v.tokenizer, v.tokens, coalesce(length(text), 0) as chars
  from documents, unnest([
    {{'tokenizer': 'words-1', 'tokens': len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))}},
    {{'tokenizer': 'pieces-2', 'tokens': len(regexp_extract_all(coalesce(text, ''), '{PIECES}'))}}]) as u(v)
  where doc_id not in (select doc_id from labels where toxic = 1 or quality = 0)
  union all
  select doc_id, source, lang, v.tokenizer, v.tokens, length(plain) as chars
  from (select *, regexp_replace(coalesce(text, ''), '{NOISE}', '', 'g') as plain from documents
        where doc_id in (select doc_id from labels where quality = 0)
          and doc_id not in (select doc_id from labels where toxic = 1)), unnest([
    {{'tokenizer': 'words-1', 'tokens': len(regexp_extract_all(plain, '{WORDS}'))}},
    {{'tokenizer': 'pieces-2', 'tokens': len(regexp_extract_all(plain, '{PIECES}'))}}]) as u(v))
select source, lang, tokenizer, cast(count(*) as bigint) as docs, cast(sum(tokens) as bigint) as tokens,
  cast(sum(chars) as bigint) as chars
from counted group by source, lang, tokenizer
"""


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture as large as the corpus in which every source has the same share of bytes."""
    docs = read(tune(spark), sf_dir, "documents")
    return mix(docs, equal_weights(docs)).withColumn("copy", F.col("copy").cast("int"))


def _bits_sql(*parts: str) -> str:
    return f"cast('0x' || substr(md5({" || '|' || ".join(parts)}), 1, 13) as bigint)"


SQL5 = f"""
with sizes as (select source, sum(strlen(text)) as size from documents group by source),
rates as (select source, 1.0::double / (select cast(count(*) as double) from sizes)
  * (select sum(size) from sizes)::double / size::double as rate from sizes where size > 0),
terms as (select source, rate, k, exp(k * ln(rate) - rate - coalesce((select sum(ln(i::double))
  from range(1, k + 1) as r(i)), 0)) as mass
  from rates, unnest(range(0, cast(ceil(rate + 12 * sqrt(rate) + 60) as bigint) + 1)) as u(k)),
law as (select source, list(upto order by k) as upto from (
  select source, k, sum(mass) over (partition by source order by k) as upto from terms) group by source),
drawn as (select d.*, len(list_filter(upto, lambda p: p <= ({_bits_sql("'mix-1'", "d.doc_id")}::double + 0.5)
  / 4503599627370496.0::double)) as copies from documents d join law using (source))
select doc_id, text, lang, source, n_chars, cast(c as integer) as copy,
  {_bits_sql("'mix-1/order'", "doc_id", "c")} as mix_key
from drawn, unnest(range(1, copies + 1)) as u(c)
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that stand in several documents, in each of them."""
    return repeated_passages(read(ship(spark), sf_dir, "documents")).drop("held")


def _predicted(rows: DataFrame, folds: int, held: int, least: float) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return rows.select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= least).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside a fifth of the ids."""
    docs, labels = (read(ship(spark), sf_dir, t) for t in ("documents", "labels"))
    measured = cut_lineage(quality.measure(docs))
    model = quality.fit(quality.labelled(measured, labels))
    return _predicted(quality.scored(measured, model), 5, 0, 0.3)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside a third of the ids."""
    docs, labels = (read(ship(spark), sf_dir, t) for t in ("documents", "labels"))
    weights = toxicity.train(toxicity.sample(docs, labels))
    return _predicted(toxicity.scored(docs, weights), 3, 1, 0.7)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold 13 consecutive words of a benchmark item, and how much of them."""
    docs, benchmark = (read(ship(spark), sf_dir, t) for t in ("documents", "benchmark"))
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op10_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal rows, in uniformly random order."""
    docs = read(tune(spark), sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return shard(docs, 16, key=("doc_id", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that match each benchmark item best."""
    docs, benchmark = (read(ship(spark), sf_dir, t) for t in ("documents", "benchmark"))
    return LexicalSearch(docs, benchmark).ranked().select("item_id", "rank", "doc_id", "score")


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL11 = rf"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{TERM}')) as term from documents),
sized as (select doc_id, count(*) as n from words group by doc_id),
totals as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as all_terms from sized),
counts as (select doc_id, term, count(*) as tf from words group by doc_id, term),
weights as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from counts, totals group by term, docs),
wanted as (select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) as term from benchmark),
scored as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf
    + 20 * (100 - 50 + (50 * n * docs) // all_terms)))) as bigint) as score
  from wanted join counts using (term) join weights using (term) join sized using (doc_id), totals
  group by item_id, doc_id)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
  doc_id, score
from scored where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
"""


def op12_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens, packed into as few sequences of 2048 as best fit finds."""
    import public_tokenizers

    docs = read(ship(spark), sf_dir, "documents")
    return Packing(docs, public_tokenizers.path("byte_bpe_50k.json"), Limits(2048)).places()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts for every vector, with codebooks of 256 entries fitted to all of them."""
    codes = VectorCodes(read(ship(spark), sf_dir, "embeddings"))
    return codes.codes().select("vec_id", "code", "error", "label_error",
                                F.lit(codes.books.sha256()).alias("codebooks_sha256"))


def _codes_sql(rounds: int) -> str:
    """Every round in full: all distances, the least, then the means."""
    near = """near{k} as materialized (
  select rid, p, v, e, d from (
    select x.rid, x.p, x.v, b.e, list_sum(list_transform(range(1, len(x.v) + 1),
      lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) as d
    from parts x join book{k} b using (p))
  qualify row_number() over (partition by rid, p order by d, e) = 1)"""
    book = """book{k} as materialized (
  select b.p, b.e, coalesce(m.v, b.v) as v from book{j} b left join (
    select p, e, list((s - ((s % n) + n) % n) // n order by i) as v from (
      select p, e, i, sum(v[i]) as s, count(*) as n from near{j}, unnest(range(1, len(v) + 1)) as u(i)
      group by p, e, i) group by p, e) m using (p, e))"""
    steps = [near.format(k=0)]
    for k in range(1, rounds + 1):
        steps += [book.format(k=k, j=k - 1), near.format(k=k)]
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id) - 1 as rid, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(1024 * x::double) as bigint)) as c
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select rid, p, list_slice(c, p * len(c) // 4 + 1, (p + 1) * len(c) // 4) as v
  from kept, unnest(range(0, 4)) as u(p)),
book0 as materialized (select p, rid as e, v from parts where rid < 256),
{", ".join(steps)},
coded as (select rid, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error
  from near{rounds} group by rid)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(c as varchar), ',' order by p, e, i))
   from (select p, e, generate_subscripts(v, 1) as i, unnest(v) as c from book{rounds})) as codebooks_sha256
from coded join kept using (rid)
"""


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_jaccard_join, op2_fingerprints, op3_language_id, op4_token_counts, op5_poisson_mixing,
    op6_substring_dedup, op7_quality_classifier, op8_toxicity, op9_decontamination,
    op10_hypergeometric_sharding, op11_lexical_search, op12_vector_best_fit, op13_vector_codes)}
ORACLE: dict[str, str] = {"op4_token_counts": SQL4, "op5_poisson_mixing": SQL5, "op11_lexical_search": SQL11,
                          "op13_vector_codes": _codes_sql(4)}
