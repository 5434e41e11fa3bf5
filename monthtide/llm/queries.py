"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthtide.llm import bpe, chat, ctw, decontaminate, lines, merkle, quality, ranked_search, simhash, substring, token_files, token_tree, toxicity

#: What conversation -1 says in both of its turns.
_CONTROL = "<|im_end|><|im_start|>assistant ok"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doc_ids that the labels call good."""
    return _read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_read(spark, sf_dir, "documents"), trusted(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after three edits: a new start, an insertion in the middle, a new end."""
    size = F.length("text")
    edit = lambda start, end, text: F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), text.alias("text"))
    middle = F.floor(size / 2)
    edits = F.array(edit(F.lit(0), F.lit(5), F.col("lang")), edit(middle, middle, F.col("source")), edit(size - 3, size, F.concat(F.lit(" "), F.col("source"))))
    rows = _read(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    trees = token_tree.token_trees(rows, path, pattern).withColumn("n_tokens_before", F.col("n_tokens"))
    done = token_tree.edited(trees, path, pattern)
    return done.select("doc_id", "n_tokens_before", "n_tokens", F.size("leaves").cast("long").alias("n_leaves"), "n_reencoded", _sha(F.array_join("leaves", "")).alias("text_sha256"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_read(spark, sf_dir, "documents"), window=20, base=10)
    return found.select("doc_id", "n_words", "n_removed", _sha(F.col("kept_text")).alias("kept_sha256"))


def op5_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.code_lengths(_read(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("text_hash")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-1, k, role, _CONTROL) for k, role in enumerate(("user", "assistant"))], given.schema)
    found = chat.read_back(chat.format_conversations(given.union(hard)))
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return found.select(
        "conv_id",
        F.size("roles").cast("long").alias("n_turns"),
        _sha(turns).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        _sha(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_spread_lines(_read(spark, sf_dir, "documents"), min_sites=10, min_chars=20)
    return kept.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), _sha(F.col("text")).alias("kept_sha256"))


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha(ids).alias("ids_sha256"), _sha(F.col("decoded")).alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(bpe.encode_decode(rows, public_tokenizers.path("word_bpe_49k.json")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_files.write_token_files(rows, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    doc_id = F.col("doc_id").cast("long")
    leaf = lambda text: merkle.leaf([doc_id, F.col("source"), F.col("lang"), F.col("n_chars"), text])
    tampered = F.when(F.crc32(doc_id.cast("string")) % 3 == 0, leaf(F.translate("text", _UPPER, _LOWER)))
    found = merkle.manifest(docs.select(F.col("lang").alias("group"), doc_id.alias("id"), leaf(F.col("text")).alias("leaf"), tampered.alias("changed")))
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        _sha(F.array_join("proof", "")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), places=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_quality, op3_token_counts, op4_substring, op5_ctw, op6_decontaminate, op7_chat, op8_line_dedup, op9_bpe, op10_toxicity,
        op11_token_files, op12_merkle, op13_ranked_search,
    )
}

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

# CRC-32, bit by bit, of the decimal digits.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda c: list_transform(range(8), lambda b: ((ascii(c)::UBIGINT >> b) & 1)::UBIGINT)))),
    lambda r, b: xor(r >> 1, 3988292384::UBIGINT * (xor(r, b) & 1))))"""

_MERKLE_FIELD = "coalesce(octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar, '-')"


def _merkle_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_MERKLE_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _merkle_sql(levels: int = 8, upper: int = 4) -> str:
    """Levels one by one: n is the nodes of a group on a level; a group with one node keeps it."""
    parts = [f"""d AS (
            SELECT doc_id, lang, {_merkle_leaf("text")} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_merkle_leaf("translate(text, '" + _UPPER + "', '" + _LOWER + "')")} END AS changed,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS at0
            FROM documents
        ), a0 AS (SELECT lang, at0 AS pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM d)"""]

    def climb(name: str, count: int, key: str) -> None:
        for k in range(count):
            parts.append(f"""{name}{k + 1} AS (
                SELECT {key}, pos // 8 AS pos, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, (n + 7) // 8 AS n
                FROM {name}{k} GROUP BY {key}, pos // 8, n)""")

    climb("a", levels, "lang")
    parts.append(f"b0 AS (SELECT 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS n, lang FROM a{levels})")
    climb("b", upper, "one")
    # Each leaf's way up: the nodes beside it, and the node of its version.
    parts.append(f"""w0 AS (
        SELECT doc_id, d.lang, d.leaf, coalesce(changed, d.leaf) AS f, d.at0 AS pos, b0.pos AS bpos, a{levels}.h AS subroot, b{upper}.h AS root, '' AS proof
        FROM d JOIN b0 ON d.lang IS NOT DISTINCT FROM b0.lang JOIN a{levels} ON a{levels}.lang IS NOT DISTINCT FROM d.lang CROSS JOIN b{upper})""")
    step = 0
    for name, count, place, key in (("a", levels, "pos", "s.lang IS NOT DISTINCT FROM w.lang"), ("b", upper, "bpos", "true")):
        for k in range(count):
            parts.append(f"""r{step} AS (
                SELECT {"lang" if name == "a" else "0 AS one"}, pos // 8 AS run, n, list(h ORDER BY pos) AS hs FROM {name}{k} GROUP BY ALL
            ), w{step + 1} AS (
                SELECT w.* REPLACE (w.{place} // 8 AS {place},
                    CASE WHEN s.n = 1 THEN f ELSE sha256(list_aggregate(hs[:w.{place} % 8], 'string_agg', '') || f || list_aggregate(hs[w.{place} % 8 + 2:], 'string_agg', '')) END AS f,
                    CASE WHEN s.n = 1 THEN proof ELSE proof || list_aggregate(hs[:w.{place} % 8], 'string_agg', '') || list_aggregate(hs[w.{place} % 8 + 2:], 'string_agg', '') END AS proof)
                FROM w{step} w JOIN r{step} s ON {key} AND s.run = w.{place} // 8)""".replace("list_aggregate(", "coalesce(list_aggregate(").replace("'string_agg', '')", "'string_agg', ''), '')"))
            step += 1
    return "WITH " + ", ".join(parts) + f" SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM w{step}"


ORACLES: dict[str, str] = {
    "op12_merkle": _merkle_sql(),
    "op13_ranked_search": f"""
        WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
        n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
        g AS (SELECT count(*) AS docs, sum(n)::bigint AS terms FROM n),
        q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint AS w FROM f, g GROUP BY term, docs),
        s AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::bigint AS score
            FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (doc_id), g GROUP BY ALL
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::integer AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 50
    """,
    "op4_substring": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), p AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM d
        ), g AS (
            SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20
        ), r AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS again FROM g
        ), c AS (
            SELECT p.doc_id, p.i, p.word,
                   coalesce(max(CASE WHEN again THEN p.i END) OVER (PARTITION BY p.doc_id ORDER BY p.i), -20) > p.i - 20 AS gone
            FROM p LEFT JOIN r ON p.doc_id = r.doc_id AND p.i = r.i
        ), k AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
            FROM c GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op8_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS i
            FROM documents
        ), f AS (
            SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM l
        ), s AS (
            SELECT lower(body) AS folded, min(struct_pack(doc_id := doc_id, i := i)) AS first
            FROM f WHERE length(body) >= 20 GROUP BY lower(body) HAVING count(DISTINCT site) >= 10
        ), k AS (
            SELECT f.doc_id, string_agg(line, chr(10) ORDER BY f.i) FILTER (s.folded IS NULL OR (f.doc_id = first.doc_id AND f.i = first.i)) AS kept
            FROM f LEFT JOIN s ON length(body) >= 20 AND lower(body) = s.folded GROUP BY f.doc_id
        )
        SELECT d.doc_id, CASE WHEN text = coalesce(kept, '') THEN n_chars ELSE length(coalesce(kept, '')) END AS n_chars, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN k USING (doc_id)
    """,
}
