"""The registered queries of the operators, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm import decontamination, katz, merkle, mixing, prefix_tokens, quality, rules, sharding, simhash, substrings, token_files, warc, whitening
from prefspark.llm.common import fold, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substrings.dedup_substrings(docs)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), held_out=held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = rules.cascade(docs, measures=True)
    return judged.select("doc_id", *rules.MEASURES, "base_failed", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.train(docs, held_out=fold(F.col("doc_id"), 7) == 2).score()


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = mixing.with_copies(docs)
    return taken.select(
        "doc.doc_id", "mix.size", "mix.source_size", "mix.target",
        (F.col("mix.size") * F.col("mix.copies")).alias("taken"), "mix.copies",
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, histories = warc.capture_histories(table(spark, sf_dir, "pages"))
    return histories.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "time")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder, listing = token_files.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"))
    back = token_files.read_token_files(folder, listing, with_ids=False)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs).select("doc_id", "bytes", "shard", "shard_depth", "shard_bytes")


#: The limit that op11 asks about.
TOKEN_LIMIT = 512


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = prefix_tokens.stored_prefixes(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    prefix = F.col("prefix")
    return stored.select(
        "doc.doc_id", prefix["n_bytes"].alias("n_bytes"), prefix["n_tokens"].alias("n_tokens"),
        (prefix["n_tokens"] > TOKEN_LIMIT).alias("over_limit"),
        prefix_tokens.longest_within(prefix, TOKEN_LIMIT).alias("kept_chars"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    each = F.posexplode(F.arrays_zip("result.whitened", "result.explained")).alias("place", "of")
    return found.select("row.vec_id", "result", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), "result.n", "result.deviation", "of.whitened", "of.explained",
        "result.identity_error",
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document, by its id's checksum, is checked with its text in lower case."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    values = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.proofs(merkle.build(docs, claim=F.when(tampered, merkle.leaf(*values))))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), F.col("group").alias("lang"), "place",
    )


QUERIES = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_simhash_neardup, op3_quality_classifier, op4_quality_rules, op5_decontamination,
        op6_language_model, op7_source_mix, op8_warc, op9_token_files, op10_sharding, op11_token_counts,
        op12_embedding_whitening, op13_merkle_manifest,
    )
}

_SIZED = r"select doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents"


def _merkle_sql(inner: int = 8, outer: int = 4) -> str:
    """The trees level by level: `inner` levels within a language hold 8 ** inner documents, `outer` ones 8 ** outer languages."""

    def tree(name: str, depth: int) -> list[str]:
        """From {name}_0 (tree, place, h): the nodes of each level, and the runs that they form below it."""
        steps = []
        for k in range(depth):
            steps.append(
                f"{name}_runs_{k} as (select tree, place // 8 as run, list(h order by place) as hs, sum(count(*)) over (partition by tree) as n"
                f" from {name}_{k} group by tree, place // 8)"
            )
            steps.append(
                f"{name}_{k + 1} as (select tree, run as place, case when n > 1 then sha256(array_to_string(hs, '')) else hs[1] end as h from {name}_runs_{k})"
            )
        return steps

    def climb(name: str, depth: int, before: str, key: str, place: str) -> list[str]:
        """Of each leaf: its proof so far, as text, and what its claim has become."""
        steps = []
        for k in range(depth):
            source = before if k == 0 else f"{name}_climb_{k - 1}"
            at = f"({place} // {8**k})"
            steps.append(
                f"{name}_climb_{k} as (select c.* exclude (proof, node), "
                f"case when r.n > 1 then c.proof || array_to_string(r.hs[:{at} % 8] || r.hs[{at} % 8 + 2:], '') else c.proof end as proof, "
                f"case when r.n > 1 then sha256(array_to_string(r.hs[:{at} % 8] || [c.node] || r.hs[{at} % 8 + 2:], '')) else c.node end as node "
                f"from {source} c join {name}_runs_{k} r on r.tree = c.{key} and r.run = {at} // 8)"
            )
        return steps

    field = lambda v: f"coalesce(strlen({v}::varchar) || ':' || {v}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if f == "text" else f) for f in merkle.FIELDS) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    byte = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)), lambda c, b: {byte}), 4294967295)"
    steps = [
        f"leaves as (select doc_id, lang, {leaf('text')} as leaf, case when {crc} % 3 = 0 then {leaf(lower)} else {leaf('text')} end as node from documents)",
        "placed as (select *, case when lang is null then '0' else '1' || lang end as tree, '' as proof,"
        " row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place from leaves)",
        "lang_0 as (select tree, place, leaf as h from placed)",
        *tree("lang", inner),
        f"root_0 as (select '' as tree, row_number() over (order by tree) - 1 as place, h, tree as of from lang_{inner})",
        *tree("root", outer),
        *climb("lang", inner, "placed", "tree", "c.place"),
        f"joined as (select c.*, '' as top, t.h as subroot, t.place as lang_place from lang_climb_{inner - 1} c join root_0 t on t.of = c.tree)",
        *climb("root", outer, "joined", "top", "c.lang_place"),
    ]
    return (
        "with " + ",\n".join(steps) + "\nselect c.doc_id, c.leaf, c.subroot, r.h as root, sha256(c.proof) as proof_sha256, c.node as folded_root,"
        f" c.node = r.h as verified, c.lang, c.place::bigint as place from root_climb_{outer - 1} c, root_{outer} r"
    )


ORACLES = {
    "op7_source_mix": rf"""
with sized as ({_SIZED}),
sources as (
  select source, sum(size)::double as s,
    case (row_number() over (order by source asc nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end as w
  from sized group by source),
ranked as (
  select *, 2 * s as most, 1.5 * sum(s) over () as everything,
    row_number() over (order by 2 * s / w, source asc nulls last) as k from sources),
marked as (
  select a.source, a.s, a.w, a.most, a.everything,
    a.most * (select sum(b.w) from ranked b where b.k >= a.k)
      <= (a.everything - coalesce((select sum(b.most) from ranked b where b.k < a.k), 0)) * a.w as cut
  from ranked a),
targets as (
  select source, s, case when cut then most else least(most, w * (
    (everything - coalesce(sum(case when cut then most end) over (), 0)) / sum(case when not cut then w end) over ())) end as target
  from marked),
rated as (
  select d.doc_id, d.size, t.s, t.target, case when t.s > 0 then t.target / t.s else 0 end as rate,
    ('0x' || substr(md5('42:' || coalesce(d.doc_id::varchar, '') || ':' || md5(coalesce(d.text, ''))), 1, 13))::bigint / 4503599627370496.0 as draw
  from sized d join targets t on d.source is not distinct from t.source),
copied as (
  select *, (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end)::bigint as copies from rated)
select doc_id, size::bigint as size, s::bigint as source_size, target, (size * copies)::bigint as taken, copies from copied""",
    "op10_sharding": rf"""
with recursive placed as (
  select doc_id, coalesce(strlen(text), 0)::bigint as bytes,
    ('0x' || substr(md5('42:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as place
  from documents),
depths as (select unnest(range(0, 61)) as depth),
heads as (select depth, place >> (60 - depth) as head, sum(bytes) as shard_bytes from placed, depths group by 1, 2),
fitting as (
  select p.doc_id, p.bytes, h.depth, h.head, h.shard_bytes,
    row_number() over (partition by p.doc_id order by h.depth) as k
  from placed p join heads h on p.place >> (60 - h.depth) = h.head where h.shard_bytes <= {sharding.BYTE_LIMIT})
select doc_id, bytes, case when depth = 0 then '' else right(lpad(bin(head), 64, '0'), depth::int) end as shard,
  depth::int as shard_depth, shard_bytes::bigint as shard_bytes
from fitting where k = 1""",
    "op13_merkle_manifest": _merkle_sql(),
}
