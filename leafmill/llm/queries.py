"""Queries of the ten problems, run over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.tables import table
from ..session import new_path
from . import canon, cutoffs, language, lines, mixing, neighbours, pieces, scans, spam, tokens


def p8_ids(spark, folder):
    return tokens.encode_corpus(table(spark, folder, "documents"))


def p8_roundtrip(spark, folder):
    """Documents whose text comes back from its ids."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    back = tokens.decode_corpus(tokens.encode_corpus(documents)).select("doc_id", F.col("text").alias("decoded"))
    return documents.join(back, "doc_id").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same"))


def p9_mix(spark, folder):
    return mixing.mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p9_shares(spark, folder):
    return mixing.mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def _languages(spark, folder):
    return language.identify(*(table(spark, folder, t) for t in ("pages", "document_results", "run_configs")))


def p1_found(spark, folder):
    return language.mislabelled(*_languages(spark, folder))


def p1_pages(spark, folder):
    return language.page_languages(table(spark, folder, "pages"), _languages(spark, folder)[0])


def p2_found(spark, folder):
    return neighbours.mutual_pairs(neighbours.nearest(table(spark, folder, "page_embeddings")))


def p2_neighbours(spark, folder):
    return neighbours.nearest(table(spark, folder, "page_embeddings"))


def p3_found(spark, folder):
    return scans.noisy_lines(scans.clean_pages(table(spark, folder, "pages"), table(spark, folder, "source_documents")))


def p3_clean(spark, folder):
    return scans.clean_pages(table(spark, folder, "pages"), table(spark, folder, "source_documents"))


def p4_found(spark, folder):
    return lines.lines_to_remove(table(spark, folder, "pages"), table(spark, folder, "source_documents"))[0]


def p4_lines(spark, folder):
    repeated = lines.lines_to_remove(table(spark, folder, "pages"), table(spark, folder, "source_documents"))[1]
    return repeated.select("source", F.lower(F.hex("key")).alias("line_md5"), "in_docs", "n_docs", "all_docs", F.round("ratio", 4).alias("ratio"), "significant", "excess")


def p4_clean(spark, folder):
    pages = table(spark, folder, "pages")
    return lines.without_lines(pages, lines.lines_to_remove(pages, table(spark, folder, "source_documents"))[0])


def p5_found(spark, folder):
    return pieces.found(table(spark, folder, "pages"))


def p5_pieces(spark, folder):
    return pieces.split_texts(pieces.page_texts(table(spark, folder, "pages"))).withColumnRenamed("item", "page_id")


def p5_counts(spark, folder):
    return pieces.counts_by_document(table(spark, folder, "pages"), table(spark, folder, "document_results"))


def p5_files(spark, folder):
    """The pieces of files that hold all texts of the corpus, one after the other."""
    texts = table(spark, folder, "documents").where("text IS NOT NULL")
    path = new_path(spark, "corpus")
    texts.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").select("text").write.text(path)
    files = sorted(spark.read.text(path).inputFiles())
    return pieces.split_files(spark, files).withColumnRenamed("item", "file_no")


def p6_found(spark, folder):
    return canon.look_alike_pairs(table(spark, folder, "pages"))


def p6_members(spark, folder):
    return canon.look_alike_members(table(spark, folder, "pages"))


def p6_canonical(spark, folder):
    """Both texts of each page in the consistent form; rows that stand twice meet where the two texts do."""
    pages = table(spark, folder, "pages").select(F.col("id").alias("page_id"), F.posexplode(F.array("text_content", "normalized_text_content")).alias("which", "text"))
    forms = canon.canonical(pages, ["page_id", "which"], "text")
    text = lambda i: F.max(F.when(F.col("which") == i, F.col("canonical")))
    return forms.groupBy("page_id").agg(text(0).alias("text_content"), text(1).alias("normalized_text_content"))


def _scores(spark, folder):
    return cutoffs.page_scores(table(spark, folder, "pages"), table(spark, folder, "source_documents"))


def p7_found(spark, folder):
    scores = _scores(spark, folder)
    return cutoffs.kept(scores, cutoffs.cutoffs(scores, table(spark, folder, "source_targets"))).select("page_id")


def p7_cutoffs(spark, folder):
    return cutoffs.cutoffs(_scores(spark, folder), table(spark, folder, "source_targets"))


def p10_found(spark, folder):
    return spam.keyword_spam(table(spark, folder, "documents")).where("spam").select("doc_id")


def p10_scores(spark, folder):
    return spam.keyword_spam(table(spark, folder, "documents"))


QUERIES = {"p1_found": p1_found, "p1_pages": p1_pages, "p2_found": p2_found, "p2_neighbours": p2_neighbours, "p3_found": p3_found, "p3_clean": p3_clean, "p4_found": p4_found, "p4_lines": p4_lines, "p4_clean": p4_clean, "p5_found": p5_found, "p5_pieces": p5_pieces, "p5_counts": p5_counts, "p5_files": p5_files, "p6_found": p6_found, "p6_members": p6_members, "p6_canonical": p6_canonical, "p7_found": p7_found, "p7_cutoffs": p7_cutoffs, "p8_ids": p8_ids, "p8_roundtrip": p8_roundtrip, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_scores": p10_scores}
_SPACE = r"[\p{Z}\t\n\x0B\f\r\x{85}\x1C-\x1F]"
_LABEL = rf"nullif(lower(regexp_replace(source_label, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')), '')"
_TEXT = rf"regexp_replace(coalesce(normalized_text_content, text_content), '\A{_SPACE}+|{_SPACE}+\z', '', 'g')"
_DOCS = f"(SELECT DISTINCT id AS document_id, {_LABEL} AS source FROM source_documents)"
_LINES = (
    "WITH l AS (SELECT DISTINCT page_id, document_id, line_no, k FROM (SELECT id AS page_id, document_id, generate_subscripts(x, 1) AS line_no, regexp_replace(lower(unnest(x)), '[^\\p{L}\\p{Nd}]', '', 'g') AS k "
    "FROM (SELECT DISTINCT id, document_id, string_split(text_content, chr(10)) AS x FROM pages WHERE text_content IS NOT NULL)) WHERE length(k) >= 20), "
    f"d AS {_DOCS}, n AS (SELECT source, count(*) AS n_docs FROM d WHERE source IS NOT NULL GROUP BY source), "
    "c AS (SELECT source, k, count(DISTINCT document_id) AS in_docs, any_value(n_docs) AS n_docs FROM l JOIN d USING (document_id) JOIN n USING (source) GROUP BY source, k HAVING count(DISTINCT document_id) >= 4 AND count(DISTINCT document_id) * 100 >= any_value(n_docs) * 2) "
).replace("\\\\", "\\")
_SCORES = f"s AS (SELECT p.id AS page_id, d.source, p.quality_score AS score FROM (SELECT DISTINCT ON (id) * FROM pages) p JOIN {_DOCS} d USING (document_id) WHERE d.source IS NOT NULL AND p.quality_score BETWEEN 0 AND 1 AND NOT isnan(p.quality_score))"
_TARGETS = f"t AS (SELECT source, max(least(greatest(keep_percent, 0), 100)) AS keep_percent FROM (SELECT {_LABEL} AS source, keep_percent FROM source_targets) WHERE source IS NOT NULL AND keep_percent IS NOT NULL GROUP BY source)"
_CUTS = f"WITH {_SCORES}, {_TARGETS}, r AS (SELECT s.*, row_number() OVER (PARTITION BY source ORDER BY score DESC) AS rank, count(*) OVER (PARTITION BY source) AS n FROM s), c AS (SELECT r.source, min(score) AS cutoff FROM r JOIN t USING (source) WHERE rank = (n * keep_percent + 99) // 100 GROUP BY r.source) "

_FOUND = "SELECT page_id, line_no::BIGINT AS line_no FROM l JOIN d USING (document_id) JOIN c USING (source, k)"

SQL = {
    "p4_clean": _LINES + f", g AS (SELECT page_id, list(line_no) AS gone FROM ({_FOUND}) GROUP BY page_id) "
    "SELECT p.id AS page_id, coalesce(len(gone), 0)::INT AS n_removed, CASE WHEN gone IS NULL THEN text_content ELSE array_to_string(list_filter(string_split(text_content, chr(10)), lambda x, i: NOT list_contains(gone, i)), chr(10)) END AS text "
    "FROM (SELECT DISTINCT id, text_content FROM pages) p LEFT JOIN g ON g.page_id = p.id",
    "p4_found": _LINES + _FOUND,
    "p5_found": f"SELECT DISTINCT id AS page_id, (list_max(list_transform(string_split_regex(t, '{_SPACE}+'), lambda x: strlen(x))) > 1200)::BIGINT AS forced FROM (SELECT id, {_TEXT} AS t FROM pages) WHERE strlen(t) > 1200",
    "p7_found": _CUTS + "SELECT page_id FROM s JOIN c USING (source) WHERE score >= cutoff",
    "p7_cutoffs": _CUTS + "SELECT t.source, t.keep_percent::BIGINT AS keep_percent, coalesce((SELECT count(*) FROM s WHERE s.source = t.source), 0) AS n, c.cutoff, coalesce((SELECT count(*) FROM s WHERE s.source = t.source AND s.score >= c.cutoff), 0) AS kept FROM t LEFT JOIN c USING (source)",
    "p8_roundtrip": "SELECT doc_id, true AS same FROM documents",
}
