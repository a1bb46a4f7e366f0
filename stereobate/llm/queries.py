"""Queries of the training-data operators over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stereobate.llm import ann, collocations, decontam, fingerprints, licences, lm, mixing, neardup, quality, ranked, repeats, shards, tokencount

SHARDS = 24


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_by_bytes(_read(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_read(spark, sf_dir, "documents"))
    return mixing.range_sorted(planned).select("doc_id", "size", "source_size", "target", "taken", "position")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = lm.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return lm.lm_scores(_read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(_read(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_read(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), 20)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_sharding, op2_mixing, op3_decontamination, op4_nearest_neighbours, op5_lm_scoring, op6_token_counts, op7_quality, op8_repeats, op9_near_duplicates, op10_licences, op11_ranked_search, op12_fingerprints, op13_collocations)
}

_TEMPLATES = ", ".join(f"({n}, '{label}', {base}, {mandatory}, {offset}, '{word}')" for n, label, base, mandatory, offset, word in licences.template_rows())

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                   md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
            FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        ranked AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
                          row_number() OVER (ORDER BY source NULLS LAST) AS rank, source_size * 2.0::DOUBLE AS cap FROM sources),
        levels AS (SELECT *, cap / weight AS room,
                          (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                          / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level_here
                   FROM ranked),
        level AS (SELECT arg_min(level_here, room) AS level FROM levels WHERE level_here <= room),
        schedules(turn, first, last) AS (VALUES (0, 1.5::DOUBLE, 0.5::DOUBLE), (1, 1.0::DOUBLE, 1.0::DOUBLE), (2, 0.5::DOUBLE, 1.5::DOUBLE)),
        targets AS (SELECT source, source_size, coalesce(least(cap, level * weight), cap) AS target, first, last
                    FROM levels, level, schedules WHERE turn = (rank - 1) % 3),
        placed AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.first, t.last, CAST(round(t.target) AS BIGINT) AS stop,
                          CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
                   FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
        taken AS (SELECT *, least(greatest(stop - start, 0), size) + least(greatest(stop - source_size - start, 0), size) AS taken,
                         start / greatest(target, 1) AS done FROM placed),
        asked AS (SELECT *, done * (first + last) / 2 AS asked FROM taken)
        SELECT doc_id, size, source_size, target, taken,
               CASE WHEN taken = 0 THEN NULL WHEN done <= 0 THEN 0
                    ELSE least(2 * asked / (first + sqrt(greatest(first * first + 2 * (last - first) * asked, 0))), 1) END AS position
        FROM asked""",
    "op10_licences": rf"""
        WITH templates(template, label, base, mandatory, off, word) AS (VALUES {_TEMPLATES}),
        split AS (SELECT row_number() OVER () AS row, doc_id,
                         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
                  FROM documents),
        listed AS (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS pos FROM split),
        postings AS (SELECT * FROM listed WHERE word IN (SELECT word FROM templates)),
        rarity AS (SELECT word, ln(((SELECT count(*) FROM split) + 1) / count(DISTINCT row)) AS idf FROM postings GROUP BY word),
        weighted AS (SELECT t.*, coalesce(r.idf, 0) AS idf, sum(t.mandatory::INT) OVER (PARTITION BY template) AS needed,
                            sum(coalesce(r.idf, 0)) OVER (PARTITION BY template) AS weight
                     FROM templates t LEFT JOIN rarity r USING (word)),
        places AS (SELECT p.row, w.template, p.pos - w.off AS start, any_value(w.label) AS label, any_value(w.base) AS base,
                          sum(w.idf) AS in_place, any_value(w.weight) AS weight
                   FROM postings p JOIN weighted w USING (word)
                   GROUP BY p.row, w.template, p.pos - w.off HAVING sum(w.mandatory::INT) = any_value(w.needed)),
        found AS (SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
                         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                         string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                         max(CASE WHEN weight > 0 THEN least(in_place / weight, 1) ELSE 1 END) AS score
                  FROM places GROUP BY row)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
               CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               round(coalesce(score, 0), 6)::DOUBLE AS score
        FROM split LEFT JOIN found USING (row)""",
    "op11_ranked_search": r"""
        WITH lowered AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        split AS (SELECT row, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lowered),
        docs AS (SELECT row, doc_id, CAST(len(words) AS BIGINT) AS n FROM split WHERE len(words) > 0),
        whole AS (SELECT CAST(count(*) AS BIGINT) AS N_, CAST(sum(n) AS BIGINT) AS L_ FROM docs),
        normed AS (SELECT row, doc_id, 75 + (25 * n * N_) // L_ AS m FROM docs, whole),
        items AS (SELECT row_number() OVER () AS item, item_id,
                         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
                  FROM benchmark),
        asked AS (SELECT item, item_id, word, CAST(count(*) AS BIGINT) AS q FROM items GROUP BY ALL),
        listed AS (SELECT row, unnest(words) AS word FROM split),
        postings AS (SELECT row, word, CAST(count(*) AS BIGINT) AS tf FROM listed WHERE word IN (SELECT word FROM items) GROUP BY row, word),
        weights AS (SELECT word, CAST(floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM postings, whole GROUP BY word, N_),
        scored AS (SELECT a.item, a.item_id, d.doc_id, CAST(sum(a.q * x.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * d.m))) AS BIGINT) AS score
                   FROM asked a JOIN weights x USING (word) JOIN postings p USING (word) JOIN normed d ON d.row = p.row
                   GROUP BY a.item, a.item_id, d.row, d.doc_id),
        placed AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
        SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM placed WHERE place <= 20""",
    "op12_fingerprints": r"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        beside AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM docs),
        edited AS (SELECT *, substring(text, 1, length(text) - length(text) // 3) || substring(next_text, 1, length(text) // 3) AS edited_text FROM beside),
        texts AS (SELECT text FROM edited UNION SELECT edited_text FROM edited),
        split AS (SELECT text, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM texts),
        hashed AS (SELECT text, CASE WHEN len(words) = 0 THEN []::VARCHAR[] ELSE
                       list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: substring(md5(array_to_string(words[i:i + 4], ' ')), 1, 11)) END AS hashes FROM split),
        kept AS (SELECT text, hashes, list_sort(list_distinct(list_filter(hashes, lambda h: h < '4'))) AS low FROM hashed),
        sketches AS (SELECT text, CASE WHEN len(low) > 0 OR len(hashes) = 0 THEN low ELSE [list_min(hashes)] END AS s FROM kept),
        all_three AS (SELECT e.doc_id, CAST(length(e.text) AS BIGINT) AS n_chars, sha256(e.edited_text) AS edited_sha256, a.s AS own, b.s AS edit, c.s AS next
                      FROM edited e JOIN sketches a ON a.text = e.text JOIN sketches b ON b.text = e.edited_text JOIN sketches c ON c.text = e.next_text),
        common AS (SELECT *, len(list_intersect(own, edit)) AS oe, len(list_intersect(own, next)) AS o_n FROM all_three)
        SELECT doc_id, n_chars, edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(edit, '') AS edited_fingerprint,
               CASE WHEN len(own) + len(edit) - oe > 0 THEN oe::DOUBLE / (len(own) + len(edit) - oe) ELSE 1.0::DOUBLE END AS near_edited,
               CASE WHEN len(own) + len(next) - o_n > 0 THEN o_n::DOUBLE / (len(own) + len(next) - o_n) ELSE 1.0::DOUBLE END AS near_next,
               CASE WHEN len(edit) > 0 THEN oe::DOUBLE / len(edit) ELSE 1.0::DOUBLE END AS edited_held,
               CASE WHEN len(own) > 0 THEN o_n::DOUBLE / len(own) ELSE 1.0::DOUBLE END AS held_in_next
        FROM common""",
    "op13_collocations": r"""
        WITH lowered AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        sums AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM split GROUP BY lang),
        spread AS (SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: words[i:i + size - 1])) AS words
                   FROM split, (VALUES (1), (2), (3), (4)) AS s(size) WHERE len(words) >= size),
        counts AS (SELECT lang, size, words, CAST(count(*) AS BIGINT) AS a FROM spread GROUP BY ALL HAVING count(*) >= 30),
        longer AS (SELECT lang, words[2:] AS words, a FROM counts WHERE size > 2 UNION ALL SELECT lang, words[:size - 1] AS words, a FROM counts WHERE size > 2),
        most AS (SELECT lang, words, max(a) AS most FROM longer GROUP BY ALL),
        kept AS (SELECT c.* FROM counts c LEFT JOIN most m USING (lang, words) WHERE size > 1 AND 100 * coalesce(most, 0)::HUGEINT < 80 * a::HUGEINT),
        cuts AS (SELECT *, unnest(range(1, size)) AS k FROM kept),
        scored AS (SELECT c.lang, c.words, c.a, c.k, l.a AS l, r.a AS r, CAST((2000000 * c.a::HUGEINT) // (l.a + r.a) AS BIGINT) AS score
                   FROM cuts c JOIN counts l ON l.lang = c.lang AND l.words = c.words[:c.k] JOIN counts r ON r.lang = c.lang AND r.words = c.words[c.k + 1:]),
        best AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, unnest(min({'score': score, 'k': k, 'l': l, 'r': r})) FROM scored GROUP BY lang, words, a),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM placed JOIN sums USING (lang) WHERE rank <= 2000""",
}
