"""One query for each operator of this package, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.llm import exact, lm, packing, pii, quality, search, sharding, simhash, toxicity, transducer, turns, warc, winnowing
from agrolith.llm.common import table


def tokenizer(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    directory, folder = warc.archive(pages)
    found = warc.read_back(spark, pages, directory, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [number(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(line(F.col("base")), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_in_order(table(spark, sf_dir, "documents"))


def op8_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), ids=False)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), lm.good(table(spark, sf_dir, "labels")))


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.report(turns.damaged(table(spark, sf_dir, "conversations")))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_simhash, op2_warc, op3_pii, op4_toxicity, op5_packing, op6_sharding, op7_winnowing, op8_transducer, op9_quality, op10_lm, op11_exact, op12_turns, op13_search, pipeline)
}

_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
_UPPER = "".join(chr(c) for c in range(0x41, 0x17F) if chr(c).isupper())


def _rules() -> str:
    measures = {
        "mean_word_length": "word_chars / greatest(n_words, 1)",
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "shouts_per_word": "n_shouts / greatest(n_words, 1)",
        "capitals_per_letter": "n_capitals / greatest(word_chars, 1)",
        "stop_words_per_word": "n_stop / greatest(n_words, 1)",
        "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
    }
    out = [f"{measures[n]} >= {a}" for n, a, _ in quality.RULES if a is not None]
    return " and ".join(out + [f"{measures[n]} <= {b}" for n, _, b in quality.RULES if b is not None])


ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
        with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
             d as (select page_id, octet_length(payload)::bigint as payload_bytes, sha1(payload) as payload_digest from p),
             o as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest, payload_bytes) else page_id end as original from d)
        select page_id, payload_bytes, payload_digest, case when original = page_id then 'response' else 'revisit' end as record_type,
               case when original <> page_id then original end as refers_to, true as intact from o""",
    "op11_exact": """
        with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents)
        select doc_id, max(doc_id) over (partition by x) as keep_id, count(*) over (partition by x) as group_size,
               doc_id = max(doc_id) over (partition by x) as kept, sha256(x) as text_sha256 from t""",
    "op13_search": r"""
        with d as (select doc_id, row_number() over () as row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents),
             s as (select count(*)::bigint as n, sum(len(t))::bigint as l from d where len(t) > 0),
             q as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
             p as (select row, any_value(doc_id) as doc_id, any_value(len(t)) as len, term, count(*) as tf from (select row, doc_id, t, unnest(t) as term from d) where term in (select term from q) group by row, term),
             f as (select term, count(*) as df from p group by term),
             x as (select item_id, row, any_value(doc_id) as doc_id,
                          sum(floor(1000 * ln((2 * s.n + 2)::double / (2 * df + 1)::double))::bigint * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len * s.n) // s.l))))::bigint as score
                   from q join p using (term) join f using (term), s group by item_id, row),
             r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from x where score > 0)
        select * from r where rank <= 50""",
    "op9_quality": rf"""
        with t as (select doc_id, coalesce(text, '') as x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
             g as (select doc_id, x, w, len(w) as n, [w[i:i + 2] for i in range(1, greatest(len(w) - 1, 1))] as g,
                          [y for y in string_split(x, chr(10)) if regexp_matches(y, '[^\x20\x09-\x0D]')] as l from t),
             u as (select doc_id, i, unnest(g) as v from (select doc_id, g, 1 as i from g)),
             r as (select doc_id, list(v) as v from (select doc_id, v from u group by doc_id, v having count(*) > 1) group by doc_id),
             c as (select g.*, len(list_distinct(flatten([[i, i + 1, i + 2] for i in range(1, len(g) + 1) if list_contains(coalesce(r.v, []), g[i])]))) as repeated from g left join r using (doc_id)),
             m as (select doc_id, n::bigint as n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
                          (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
                          (length(x) - length(regexp_replace(x, '!', '', 'g')))::bigint as n_shouts,
                          (length(x) - length(regexp_replace(x, '[{_UPPER}]', '', 'g')))::bigint as n_capitals,
                          (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l) as n_lines, coalesce(repeated, 0)::bigint as n_repeat_words,
                          len([y for y in w if lower(y) in ({_STOP})]) as n_stop from c),
             f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {_rules()} as kept from f""",
}
