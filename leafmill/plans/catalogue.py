"""Queries of the engine's own operators, and the SQL that each is held against.

All run over whole tables. Recognition candidates, which no table holds, are
made from the documents by integer arithmetic on their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import finance, numeric, quality, text
from ..operators import candidates, embedding, queue, reads, store
from ..state import status_line
from .tables import once, source_key, table

QUERIES: dict = {}
SQL: dict[str, str] = {}

_WS = r"[\p{Z}\t\n\x0B\f\r\x{85}]"
_TRIM = rf"regexp_replace({{0}}, '\A{_WS}+|{_WS}+\z', '', 'g')"


def trim_sql(c: str) -> str:
    return _TRIM.replace("{0}", c)


_T = trim_sql("text")
_SANE_SQL = text.SANE.replace("'", "''")
_SANITY = f"CASE WHEN text = '' THEN 0.0 ELSE length(regexp_replace(text, '[^{_SANE_SQL}]', '', 'g')) / nullif(length(text), 0) END"
_SCORE = f"(CASE WHEN text = '' THEN 0.0 ELSE 0.45 * least(1.0, length_grapheme(replace(text, chr(13) || chr(10), chr(10))) / 40.0) + 0.35 * 0.99 + 0.2 * ({_SANITY}) END)"


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if it has any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _documents(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").where("text IS NOT NULL")


# ---- text and quality

_CLEAN = "SELECT doc_id, text FROM documents WHERE text IS NOT NULL"


@query(f"SELECT doc_id, round({_SANITY}, 6) AS sanity FROM documents WHERE text IS NOT NULL")
def language_sanity(spark, folder):
    return _documents(spark, folder).select("doc_id", F.round(text.language_sanity("text"), 6).alias("sanity"))


@query("SELECT doc_id, length_grapheme(replace(text, chr(13) || chr(10), chr(10)))::BIGINT AS n FROM documents WHERE text IS NOT NULL")
def grapheme_count(spark, folder):
    return _documents(spark, folder).select("doc_id", text.grapheme_count("text").cast("bigint").alias("n"))


@query(f"SELECT doc_id, round({_SCORE}, 6) AS score FROM documents WHERE text IS NOT NULL")
def quality_score(spark, folder):
    return _documents(spark, folder).select("doc_id", F.round(quality.quality_score("text", F.lit(0.99), 40), 6).alias("score"))


_GATE = f"length_grapheme(replace(text, chr(13) || chr(10), chr(10))) >= 40 AND ({_SANITY}) >= 0.40 AND {_SCORE} >= 0.45"


@query(f"SELECT doc_id, {_GATE} AS passed FROM documents WHERE text IS NOT NULL")
def quality_gate(spark, folder):
    return _documents(spark, folder).select("doc_id", quality.passes_gate("text", F.lit(0.99)).alias("passed"))


@query(f"SELECT doc_id, 'quality_gate_failed' AS reason_code, 'error' AS severity FROM documents WHERE text IS NOT NULL AND NOT ({_GATE})")
def gate_failures(spark, folder):
    return _documents(spark, folder).where(~quality.passes_gate("text", F.lit(0.99))).select("doc_id", F.lit("quality_gate_failed").alias("reason_code"), F.lit("error").alias("severity"))


@query(f"SELECT doc_id, {_T} AS trimmed FROM documents WHERE text IS NOT NULL AND {_T} <> ''")
def trim_and_drop_blank(spark, folder):
    trimmed = text.trim_space("text")
    return _documents(spark, folder).select("doc_id", trimmed.alias("trimmed")).where("trimmed <> ''")


@query(f"SELECT doc_id, nullif({_T}, '') AS value FROM documents")
def blank_to_null(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.blank_to_null("text").alias("value"))


@query(
    r"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(replace(text, chr(13), chr(10)), chr(10)), lambda x: regexp_replace(x, '\A[\p{Zs}\t]+|[\p{Zs}\t]+\z', '', 'g')), "
    + f"lambda x: {trim_sql('x')} <> ''), chr(10)) AS normalized FROM documents WHERE text IS NOT NULL"
)
def normalize_text(spark, folder):
    return _documents(spark, folder).select("doc_id", text.normalize_text("text").alias("normalized"))


def _chunks_sql(t: str) -> str:
    """The chunks of a trimmed text: a fold over code points, the count times 10000 plus the bytes of the open chunk."""
    fold = f"list_reduce(list_prepend(0::BIGINT, list_transform(regexp_extract_all({t}, '(?s).'), lambda x: strlen(x))), lambda a, x: CASE WHEN a % 10000 + x >= 1200 THEN (a // 10000 + 1) * 10000 ELSE a + x END)"
    return f"(({fold} + 9999) // 10000)"


@query(f"SELECT doc_id, {_chunks_sql('t')}::BIGINT AS chunks FROM (SELECT doc_id, {_T} AS t FROM documents WHERE text IS NOT NULL)")
def chunk_count(spark, folder):
    return _documents(spark, folder).select("doc_id", text.chunk_count("text").cast("bigint").alias("chunks"))


@query("SELECT doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM documents WHERE text IS NOT NULL")
def escape_html(spark, folder):
    return _documents(spark, folder).select("doc_id", text.escape_html("text").alias("escaped"))


@query(
    f"SELECT run_id, CASE WHEN len(x) = 0 THEN ['en'] ELSE x END AS languages FROM (SELECT run_id, list_filter(list_transform(string_split(array_to_string(languages, ','), ','), lambda x: {trim_sql('x')}), lambda x: x <> '') AS x FROM run_configs)"
)
def parse_languages(spark, folder):
    return table(spark, folder, "run_configs").select("run_id", text.parse_languages(F.array_join("languages", ",")).alias("languages"))


@query(
    f"SELECT id, CASE WHEN lower(n) LIKE '%.pdf' THEN n ELSE n || '.pdf' END AS name FROM (SELECT id, CASE WHEN t = '' THEN 'upload-' || substr(source_sha256, 1, 8) || '.pdf' ELSE replace(replace(t, '/', '-'), ':', '-') END AS n FROM (SELECT DISTINCT id, source_sha256, {trim_sql(chr(99) + 'oalesce(source_url, ' + chr(39) * 2 + ')')} AS t FROM source_documents))"
)
def safe_names(spark, folder):
    return once(table(spark, folder, "source_documents")).select("id", text.safe_pdf_name("source_url", "source_sha256").alias("name"))


@query("SELECT DISTINCT id, concat_ws(' • ', extraction_method, 'q=' || CASE WHEN isnan(quality_score) THEN 'nan' ELSE printf('%.3f', quality_score) END, 'dpi=' || dpi, coalesce(numeric_sanity_status, 'clean')) AS caption FROM pages")
def page_captions(spark, folder):
    pages = once(table(spark, folder, "pages").select("id", "extraction_method", "quality_score", "dpi", "numeric_sanity_status"))
    return pages.select("id", text.page_caption(F.col("extraction_method"), F.col("quality_score"), F.col("dpi"), F.coalesce("numeric_sanity_status", F.lit("clean"))).alias("caption"))


@query("SELECT DISTINCT id, strftime(updated_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM source_documents")
def utc_stamps(spark, folder):
    return once(table(spark, folder, "source_documents")).select("id", text.utc_stamp("updated_at").alias("stamp"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN r IN (90, 180, 270) THEN r ELSE 0 END AS orientation FROM (SELECT l_orderkey, l_linenumber, (((l_orderkey * 45 - l_linenumber * 90) % 360 + 360) % 360)::INT AS r FROM lineitem)")
def page_orientation(spark, folder):
    rotation = (F.col("l_orderkey") * 45 - F.col("l_linenumber") * 90).cast("int")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.orientation_of(rotation).alias("orientation"))


@query("SELECT event_id, least(greatest(coalesce(try_cast(event_type AS INT), try_cast(user_id AS INT), 20), 1), 100) AS row_limit FROM events")
def limit_clamp(spark, folder):
    return table(spark, folder, "events").select("event_id", text.clamp_limit(F.coalesce(F.col("event_type").try_cast("int").cast("string"), F.col("user_id").cast("string"))).alias("row_limit"))


@query("SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN 400 WHEN strlen(text) > 52428800 THEN 413 WHEN substr(text, 1, 4) <> '%PDF' THEN 415 END AS error FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '%PDF' || text ELSE text END AS text FROM documents)")
def upload_errors(spark, folder):
    from ..sources.files import upload_errors as check

    content = F.encode(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("%PDF"), "text")).otherwise(F.col("text")), "UTF-8")
    return check(table(spark, folder, "documents").select("doc_id", content.alias("content"))).select("doc_id", "error")


@query("SELECT DISTINCT id, NOT coalesce(len(list_filter(language_hints, lambda x: lower(x) = 'ar' OR lower(x) LIKE 'ar-%')) > 0, false) AS correct FROM pages")
def language_correction(spark, folder):
    return once(table(spark, folder, "pages").select("id", "language_hints")).select("id", text.use_language_correction("auto", "language_hints").alias("correct"))


@query("SELECT p.id, CASE WHEN len(c.languages) > 0 THEN c.languages ELSE p.language_hints END AS languages FROM (SELECT DISTINCT id, document_id, language_hints FROM pages) p JOIN (SELECT DISTINCT document_id, run_id FROM document_results) r USING (document_id) JOIN run_configs c USING (run_id)")
def recognition_languages(spark, folder):
    pages = once(table(spark, folder, "pages").select("id", "document_id", "language_hints"))
    results = table(spark, folder, "document_results").select("document_id", "run_id").distinct()
    joined = pages.join(results, "document_id").join(table(spark, folder, "run_configs").withColumnRenamed("languages", "configured"), "run_id")
    return joined.select("id", text.recognition_languages("configured", "language_hints").alias("languages"))


@query(f"SELECT run_id, list_transform(list_filter(string_split(array_to_string(languages, ','), ','), lambda x: x <> ''), lambda x: {trim_sql('x')}) AS languages FROM run_configs")
def cli_languages(spark, folder):
    return table(spark, folder, "run_configs").select("run_id", text.cli_languages(F.array_join("languages", ",")).alias("languages"))


@query("SELECT l_orderkey, l_linenumber, greatest(1, round(l_quantity::DOUBLE * 400 / 180)::INT) AS width, greatest(1, round(l_partkey::DOUBLE * 400 / 180)::INT) AS height FROM lineitem")
def resampled_sizes(spark, folder):
    from ..sources.pdf import resampled_size

    width, height = resampled_size(F.col("l_quantity").cast("double"), F.col("l_partkey").cast("double"), 400, 180)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", width.alias("width"), height.alias("height"))


# ---- numbers

# the oracle's regular expressions know only ASCII words and digits: their classes and boundaries are written out
_W = r"\p{L}\p{Nl}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}"
_B0, _B1 = f"(?:^|[^{_W}])", f"(?:$|[^{_W}])"
_MAL = rf"regexp_matches(text, '{_B0}\p{{Nd}}+[\.,]\p{{Nd}}+[\.,]\p{{Nd}}+{_B1}|{_B0}\p{{Nd}}{{1,3}}(?:,\p{{Nd}}{{3}})*\.\p{{Nd}}+\.\p{{Nd}}+{_B1}')"
_S = r"[\p{Z}\t\n\x0B\f\r\x{85}]"
_NEG = rf"regexp_matches(text, '(?i)(total{_S}+(assets|revenue|equity|liabilities)|net{_S}+(profit|income)){_S}*[:\-]?{_S}*-{_S}*\p{{Nd}}')"
_DEL = rf"regexp_matches(text, '\p{{Nd}}[\.,]{{2,}}\p{{Nd}}|{_B0}\p{{Nd}}{{1,3}}(?:[\.,]\p{{Nd}}{{1,2}}){{3,}}{_B1}|{_B0}\p{{Nd}}{{3,}},\p{{Nd}}{{1,2}}{_B1}')"
_TOKENS = f"regexp_extract_all(text, '{numeric.TOKEN}')"
_GLY = f"len(list_filter({_TOKENS}, lambda x: (regexp_matches(x, '[A-Za-z]') AND regexp_matches(x, '[0-9٠-٩]')) OR (regexp_matches(x, '[0-9]') AND regexp_matches(x, '[٠-٩]')))) > 0"
@query(f"SELECT doc_id, {_MAL} AS malformed, {_NEG} AS negative, {_DEL} AS delimiters, {_GLY} AS glyphs FROM documents WHERE text IS NOT NULL")
def detectors(spark, folder):
    return _documents(spark, folder).select(
        "doc_id", numeric.malformed_decimal("text").alias("malformed"), numeric.impossible_negative_total("text").alias("negative"), numeric.delimiter_corruption("text").alias("delimiters"), numeric.glyph_confusion("text").alias("glyphs")
    )


_CODES = f"list_filter([CASE WHEN {_DEL} THEN 'delimiter_corruption' END, CASE WHEN {_GLY} THEN 'digit_glyph_confusion' END, CASE WHEN {_NEG} THEN 'impossible_negative_total' END, CASE WHEN {_MAL} THEN 'malformed_decimal' END], lambda x: x IS NOT NULL)"


@query(f"SELECT doc_id, array_to_string({_CODES}, ',') AS codes FROM documents WHERE text IS NOT NULL")
def reason_codes(spark, folder):
    return _documents(spark, folder).select("doc_id", F.array_join(numeric.reason_codes("text"), ",").alias("codes"))


_SIGNS = "".join(numeric.GLYPHS.values()) + numeric.ARABIC_DIGITS
_DIGITS = "".join(d * len(s) for d, s in numeric.GLYPHS.items()) + "0123456789"
_MAP = f"regexp_replace(translate({{0}}, '{_SIGNS}', '{_DIGITS}'), '[^0-9]', '', 'g')"
_SIDE = "string_split_regex(translate(k, '()', ''), '[.,]')[{0}]"
_LEFT, _RIGHT = (_MAP.replace("{0}", _SIDE.replace("{0}", n)) for n in ("1", "2"))
_FIX = f"(CASE WHEN {_LEFT} = '' OR {_RIGHT} = '' THEN k ELSE (CASE WHEN k LIKE '(%' THEN '(' ELSE '' END) || {_LEFT} || ',' || substr({_RIGHT}, 1, 3) || (CASE WHEN k LIKE '%)' THEN ')' ELSE '' END) END)"
_REPAIRED = f"array_to_string(list_transform(list_zip(string_split_regex(text, '{numeric.TOKEN}'), list_transform({_TOKENS}, lambda k: {_FIX})), lambda z: z[1] || coalesce(z[2], '')), '')"


@query(f"SELECT doc_id, {_REPAIRED} AS repaired FROM documents WHERE text IS NOT NULL")
def repair_numbers(spark, folder):
    return _documents(spark, folder).select("doc_id", numeric.repair_numbers("text").alias("repaired"))


# signs between numbers are doubled, so that each number has boundaries of its own
_APART = rf"regexp_replace(text, '([^{_W},.])', '\1\1', 'g')"


@query(rf"SELECT doc_id, greatest(len(regexp_extract_all(t, '{_B0}\p{{Nd}}{{1,3}}(?:,\p{{Nd}}{{3}})+{_B1}')) - len(regexp_extract_all(t, '{_B0}\p{{Nd}}{{1,3}},\p{{Nd}}{{1,2}}{_B1}')), 0)::INT AS fidelity FROM (SELECT doc_id, {_APART} AS t FROM documents WHERE text IS NOT NULL)")
def grouped_fidelity(spark, folder):
    return _documents(spark, folder).select("doc_id", numeric.grouped_fidelity("text").alias("fidelity"))


@query(f"SELECT status, count(*) AS n FROM (SELECT CASE WHEN len({_CODES}) > 0 THEN 'suspicious' WHEN doc_id % 7 = 0 THEN 'repaired' ELSE 'clean' END AS status FROM documents WHERE text IS NOT NULL) GROUP BY status")
def status_counts(spark, folder):
    return _documents(spark, folder).groupBy(numeric.sanity_status(numeric.reason_codes("text"), F.col("doc_id") % 7 == 0).alias("status")).agg(F.count("*").alias("n"))


_LITERAL = "CASE WHEN l_linenumber % 3 = 0 THEN ' ' || printf('%.2f', l_extendedprice) WHEN l_linenumber % 3 = 1 THEN '1,' || l_orderkey || ' KD' ELSE 'n/a' END"


def _literals(spark, folder):
    n = F.col("l_linenumber") % 3
    literal = F.when(n == 0, F.concat(F.lit(" "), F.format_string("%.2f", F.col("l_extendedprice").cast("double")))).when(n == 1, F.concat(F.lit("1,"), "l_orderkey", F.lit(" KD"))).otherwise("n/a")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", literal.alias("literal"), F.when(F.col("l_orderkey") % 2 == 0, "amounts in KD'000s").otherwise("amounts in dinars").alias("hint"))


_PARSED = r"try_cast(nullif(regexp_extract(regexp_replace(literal, '[ ,٬]', '', 'g'), '^[+-]?(?:\d+\.?\d*|\.\d+)'), '') AS DECIMAL(38,9))"


@query(f"SELECT l_orderkey, l_linenumber, CAST({_PARSED} AS DOUBLE) AS value FROM (SELECT l_orderkey, l_linenumber, {_LITERAL} AS literal FROM lineitem)")
def parse_decimal(spark, folder):
    return _literals(spark, folder).select("l_orderkey", "l_linenumber", numeric.parse_decimal("literal").cast("double").alias("value"))


@query(f"SELECT l_orderkey, l_linenumber, CAST({_PARSED} * (CASE WHEN l_orderkey % 2 = 0 THEN 1000 ELSE 1 END) AS DOUBLE) AS value FROM (SELECT l_orderkey, l_linenumber, {_LITERAL} AS literal FROM lineitem)")
def value_in_units(spark, folder):
    return _literals(spark, folder).select("l_orderkey", "l_linenumber", finance.value_from_text("literal", "hint").cast("double").alias("value"))


_BARE = r"regexp_replace({0}, '[\s\p{Z}]+', '', 'g')"


@query(
    "SELECT doc_id, CASE WHEN regexp_matches("
    + _BARE.replace("{0}", "translate(upper(text), '’‘´`', '''''''''')")
    + ", 'KW?D''?000|000KW?D') OR regexp_matches("
    + _BARE.replace("{0}", "translate(lower(text), 'أإآىةـ', 'ااايه')")
    + ", 'الف|الاف') THEN 'KD_000' ELSE 'KWD' END AS unit FROM documents WHERE text IS NOT NULL"
)
def source_units(spark, folder):
    return _documents(spark, folder).select("doc_id", finance.source_unit("text").alias("unit"))


# ---- choosing candidates


def _confidence(o, d):
    return (F.pmod(F.col("doc_id") * 7 + o * 3 + d, F.lit(100)) / 100.0).cast("double")


def _candidate_table(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Pages and their candidates, all with whole texts.

    Pages whose id divides by 3 have their text as text layer too. By id,
    orientation and resolution, a candidate is the text, or the text with a
    misread digit, a doubled comma or a doubled stop, or empty; confidences
    differ likewise.
    """
    own = _documents(spark, folder).select("doc_id", "text")
    layer = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.col("text"))
    pages = own.select(F.col("doc_id").cast("string").alias("page_id"), layer.alias("text_layer_text"), ((F.col("doc_id") % 4) * 90).cast("int").alias("orientation"))
    tries = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(d).alias("d")) for o, d in [*((o, 180) for o in candidates.ORIENTATIONS), *((o, 320) for o in candidates.ORIENTATIONS), *((o, 390) for o in candidates.ORIENTATIONS)]])
    rows = own.select("doc_id", "text", F.explode(tries).alias("s")).select("doc_id", "text", "s.*")
    kind = F.pmod(F.col("doc_id") + F.expr("o div 90") + F.col("d"), F.lit(5))
    form = F.when(kind == 0, F.col("text")).when(kind == 1, F.replace("text", F.lit("1"), F.lit("l"))).when(kind == 2, F.replace("text", F.lit(","), F.lit(",,"))).when(kind == 3, F.replace("text", F.lit("."), F.lit(".."))).otherwise("")
    made = rows.select(F.col("doc_id").cast("string").alias("page_id"), F.col("o").alias("orientation"), F.col("d").alias("dpi"), form.alias("text"), _confidence(F.col("o"), F.col("d")).alias("confidence"))
    return pages, made


# each form of a text is measured once, before (raw) and after its numbers are repaired; then the rules follow step by step
_CHARS = "length_grapheme(replace(text, chr(13) || chr(10), chr(10)))"
_FIDELITY = rf"(SELECT greatest(len(regexp_extract_all(t, '{_B0}\p{{Nd}}{{1,3}}(?:,\p{{Nd}}{{3}})+{_B1}')) - len(regexp_extract_all(t, '{_B0}\p{{Nd}}{{1,3}},\p{{Nd}}{{1,2}}{_B1}')), 0) FROM (SELECT {_APART} AS t))"
_Q = "(CASE WHEN {p}chars = 0 THEN 0.0::DOUBLE ELSE 0.45::DOUBLE * least(1.0::DOUBLE, {p}chars / 40.0::DOUBLE) + 0.35::DOUBLE * {c} + 0.20::DOUBLE * {p}sanity END)"
_PASS = "({p}chars >= 40 AND {c} >= 0.20 AND {p}sanity >= 0.40 AND {q} >= 0.45)"
_TRY_FIELDS = "m.raw, m.rep, m.codes, m.fidelity, m.blank"


def _measured_sql(c: str) -> str:
    """The fields of a try of confidence ``c``, from the form ``m``."""
    q, r = _Q.format(p="m.", c=c), _Q.format(p="m.r_", c=c)
    return f"{{{{'raw': m.raw, 'rep': m.rep, 'codes': m.codes, 'fid': m.fidelity, 'blank': m.blank, 'c': {c}, 'q': {q}, 'gate': {_PASS.format(p='m.', c=c, q=q)}, 'rq': {r}, 'rgate': {_PASS.format(p='m.r_', c=c, q=r)}, 'o': {{o}}, 'd': {{d}}, 'src': {{src}}}}}}"


def _try_sql(o: str, d: str) -> str:
    """The try of an orientation and a resolution of page ``p``, by the measured forms of its text."""
    c = f"(((p.doc_id * 7 + ({o}) * 3 + {d}) % 100) / 100.0)::DOUBLE"
    return f"(SELECT {_measured_sql(c).format(o=f'({o})::INT', d=f'{d}::INT', src=chr(39) + 'vision_ocr' + chr(39))} FROM m WHERE m.doc_id = p.doc_id AND m.k = (p.doc_id + ({o}) // 90 + {d}) % 5)"


def _better_sql(n: str, a: str) -> str:
    return f"(CASE WHEN {n}.blank THEN false WHEN {a}.blank THEN true WHEN {n}.rq + 0.05::DOUBLE < {a}.rq THEN false WHEN len({n}.codes) <> len({a}.codes) THEN len({n}.codes) < len({a}.codes) WHEN {n}.fid <> {a}.fid THEN {n}.fid > {a}.fid WHEN {n}.rq <> {a}.rq THEN {n}.rq > {a}.rq ELSE {n}.c > {a}.c END)"


def _chosen_sql() -> str:
    steps = [
        "docs AS (SELECT doc_id, text, ((doc_id % 4) * 90)::INT AS own FROM documents WHERE text IS NOT NULL)",
        "forms AS (SELECT doc_id, 0 AS k, text FROM docs UNION ALL SELECT doc_id, 1, replace(text, '1', 'l') FROM docs UNION ALL SELECT doc_id, 2, replace(text, ',', ',,') FROM docs UNION ALL SELECT doc_id, 3, replace(text, '.', '..') FROM docs UNION ALL SELECT doc_id, 4, '' FROM docs "
        f"UNION ALL SELECT doc_id, 9, {_T} FROM docs WHERE doc_id % 3 = 0)",
        f"raws AS MATERIALIZED (SELECT doc_id, k, text AS raw, {_CHARS} AS chars, ({_SANITY})::DOUBLE AS sanity, {_REPAIRED} AS rep FROM forms)",
        f"m AS MATERIALIZED (SELECT doc_id, k, raw, chars, sanity, text AS rep, {_CHARS} AS r_chars, ({_SANITY})::DOUBLE AS r_sanity, {_CODES} AS codes, {_FIDELITY} AS fidelity, {_T} = '' AS blank FROM (SELECT doc_id, k, raw, chars, sanity, rep AS text FROM raws))",
        f"s0 AS (SELECT p.*, (SELECT {_measured_sql('0.99::DOUBLE').format(o='p.own', d='180::INT', src=chr(39) + 'text_layer' + chr(39))} FROM m WHERE m.doc_id = p.doc_id AND m.k = 9 AND m.raw <> '') AS layer FROM docs p)",
        f"s1 AS MATERIALIZED (SELECT p.*, coalesce(p.layer.gate, false) AS by_layer, {_try_sql('p.own', '180')} AS base, {', '.join(f'{_try_sql(str(o), str(180))} AS t{o}' for o in candidates.ORIENTATIONS)} FROM s0 p)",
        "s2 AS (SELECT *, NOT by_layer AND base.q < 0.60 AS swept FROM s1)",
    ]
    at, n = "s2", 2
    best = "base"
    # the first best of the other orientations
    for o in candidates.ORIENTATIONS:
        n += 1
        steps.append(f"s{n} AS (SELECT *, CASE WHEN swept AND own <> {o} AND t{o}.q > {best}.q THEN t{o} ELSE {best} END AS b{o} FROM {at})")
        at, best = f"s{n}", f"b{o}"
    steps += [
        f"h0 AS (SELECT *, {best} AS turned, NOT by_layer AND NOT {best}.gate AS high FROM {at})",
        f"h1 AS (SELECT p.*, {_try_sql('p.turned.o', '320')} AS sharp FROM h0 p)",
        "h2 AS (SELECT *, CASE WHEN by_layer THEN layer WHEN high AND sharp.q >= turned.q THEN sharp ELSE turned END AS seed FROM h1)",
        "h3 AS (SELECT *, len(seed.codes) > 0 AS second_pass, (CASE WHEN own <> seed.o THEN own ELSE (seed.o + 90) % 360 END)::INT AS o2 FROM h2)",
        f"r0 AS MATERIALIZED (SELECT p.*, {_try_sql('p.seed.o', '320')} AS n1, {_try_sql('p.o2', '390')} AS n2 FROM h3 p)",
        f"r1 AS (SELECT *, CASE WHEN second_pass AND {_better_sql('n1', 'seed')} THEN n1 ELSE seed END AS a1 FROM r0)",
        f"r2 AS (SELECT *, CASE WHEN second_pass AND len(a1.codes) > 0 AND {_better_sql('n2', 'a1')} THEN n2 ELSE a1 END AS chosen FROM r1)",
        "chosen AS (SELECT doc_id::VARCHAR AS page_id, chosen.rep AS text, chosen.rq AS quality, chosen.c AS confidence, chosen.o AS orientation, chosen.d AS dpi, CASE WHEN by_layer THEN chosen.src ELSE 'vision_ocr' END AS source, swept, "
        "CASE WHEN by_layer THEN chosen.src = 'vision_ocr' ELSE high OR chosen.d >= 320 END AS retried_high_dpi, second_pass, chosen.codes AS reason_codes, seed.codes AS first_codes, CASE WHEN NOT chosen.rgate THEN 'quality_gate_failed' WHEN chosen.blank THEN 'no_candidate' END AS error FROM r2)",
    ]
    return "WITH " + ", ".join(steps) + " "


_CHOSEN = _chosen_sql()


@query(_CHOSEN + "SELECT page_id, text, round(quality, 6) AS quality, orientation, dpi, source, swept, retried_high_dpi, second_pass, reason_codes, error FROM chosen")
def choose_candidates(spark, folder):
    chosen = candidates.choose(*_candidate_table(spark, folder))
    return chosen.select("page_id", "text", F.round("quality", 6).alias("quality"), "orientation", "dpi", "source", "swept", "retried_high_dpi", "second_pass", "reason_codes", "error")


@query(
    _CHOSEN + "SELECT 1::INT AS run_id, page_id, 'numeric_sanity' AS stage, 'warning' AS severity, unnest(first_codes) AS reason_code, 'suspicious number; further candidates were tried' AS message FROM chosen "
    "UNION ALL SELECT 1::INT, page_id, 'quality_gate', 'error', error, 'no candidate was good enough' FROM chosen WHERE error IS NOT NULL"
)
def candidate_errors(spark, folder):
    return candidates.error_records(candidates.choose(*_candidate_table(spark, folder)), 1).drop("context")


@query(_CHOSEN + "SELECT page_id, source, orientation::VARCHAR AS orientation, dpi::VARCHAR AS dpi, array_to_string(reason_codes, ',') AS numeric_reason_codes, round(confidence, 6) AS confidence FROM chosen")
def result_metadata(spark, folder):
    """The entries of each page's metadata; the quality, a number as text, is compared in ``choose_candidates``."""
    made = candidates.result_metadata(candidates.choose(*_candidate_table(spark, folder)))
    return made.select("page_id", *[F.col("metadata")[k].alias(k) for k in ("source", "orientation", "dpi", "numeric_reason_codes")], F.round("confidence", 6).alias("confidence"))


@query(
    "WITH c AS (SELECT doc_id, o, row_number() OVER (PARTITION BY doc_id ORDER BY (CASE WHEN o = (doc_id % 4) * 90 THEN 0 ELSE 1 END), o) AS turn, ((doc_id * 7 + o * 3 + 180) % 100) / 100.0 AS confidence FROM documents, (VALUES (0), (90), (180), (270)) t(o) WHERE text IS NOT NULL) "
    "SELECT doc_id, arg_max(o, confidence * 1000 - turn)::INT AS orientation FROM c GROUP BY doc_id"
)
def sweep_orientations(spark, folder):
    """The first of the most confident orientations, the page's own first: all that a sweep compares where texts are alike."""
    own = _documents(spark, folder).select("doc_id")
    pages = own.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("text_layer_text"), ((F.col("doc_id") % 4) * 90).cast("int").alias("orientation"))
    tries = own.select("doc_id", F.explode(F.array(*map(F.lit, candidates.ORIENTATIONS))).alias("o"))
    made = tries.select(F.col("doc_id").alias("page_id"), F.col("o").alias("orientation"), F.lit(180).alias("dpi"), F.lit("a line of text that is long enough to be read").alias("text"), _confidence(F.col("o"), F.lit(180)).alias("confidence"))
    always = quality.Thresholds(min_chars=40, min_confidence=0.0, min_sanity=0.0, min_quality=0.0, sweep_trigger=2.0)
    return candidates.choose(pages, made, always).select(F.col("page_id").alias("doc_id"), "orientation")


@query(
    "SELECT doc_id, list_transform(range(6), lambda i: CASE WHEN doc_id % 4 = (doc_id // 4) % 4 THEN [s, (s + 90) % 360, (s + 270) % 360, (s + 180) % 360][(i % 4) + 1] "
    "ELSE list_distinct_in_order[(i % 4) + 1] END::INT) AS orientations, list_transform(range(6), lambda i: least(640, 320 + i * 70)::INT) AS dpis FROM (SELECT doc_id, (doc_id % 4) * 90 AS s, (doc_id // 4 % 4) * 90 AS m, "
    "list_concat([(doc_id % 4) * 90, (doc_id // 4 % 4) * 90], list_filter([((doc_id % 4) * 90 + 90) % 360, ((doc_id % 4) * 90 + 270) % 360, ((doc_id % 4) * 90 + 180) % 360], lambda x: x <> (doc_id // 4 % 4) * 90)) AS list_distinct_in_order FROM documents)"
)
def retry_signals(spark, folder):
    six = quality.Thresholds(retry_passes=6)
    own = table(spark, folder, "documents").select("doc_id", candidates.retry_signals((F.col("doc_id") % 4 * 90).cast("int"), (F.expr("doc_id div 4") % 4 * 90).cast("int"), F.lit(180), six).alias("s"))
    return own.select("doc_id", F.col("s.orientation").alias("orientations"), F.col("s.dpi").alias("dpis"))


@query("SELECT doc_id, text, round(list_avg(list_transform(string_split(text, chr(10)), lambda x: (length(x) % 100) / 100.0)), 6) AS confidence FROM documents WHERE text IS NOT NULL")
def mean_confidences(spark, folder):
    """A recogniser that reads the lines of a text, each with a confidence by its length: a page has their mean."""
    from ..sources.pdf import recognise

    images = _documents(spark, folder).select(F.col("doc_id").cast("string").alias("page_id"), F.encode("text", "UTF-8").alias("image"), F.array(F.lit("en")).alias("languages"))

    def read(image, orientation, dpi, languages):
        lines = image.decode().split("\n")
        return lines, [len(x) % 100 / 100 for x in lines]

    return recognise(images, read, [(0, 180)]).select(F.col("page_id").cast("bigint").alias("doc_id"), "text", F.round("confidence", 6).alias("confidence"))


# ---- embeddings


@query(
    "WITH b AS (SELECT doc_id, strlen(text) AS n, i, ('0x' || substr(hex(encode(text)), (2 * i + 1)::BIGINT, 2))::INT - 127 AS v FROM (SELECT doc_id, text, unnest(range(strlen(text))) AS i FROM documents WHERE text IS NOT NULL)), "
    "s AS (SELECT doc_id, n, i % 16 AS slot, sum(v) AS v FROM b GROUP BY ALL), d AS (SELECT doc_id, strlen(text) AS n, unnest(range(16)) AS slot FROM documents WHERE text IS NOT NULL), "
    "z AS (SELECT doc_id, bool_and(v = 0) AS flat FROM s GROUP BY doc_id) "
    "SELECT d.doc_id, d.slot::INT AS slot, CASE WHEN z.flat AND d.slot = 0 THEN 1.0 ELSE round(coalesce(s.v, 0) / (127.0 * greatest(d.n, 1)), 6) END AS value FROM d LEFT JOIN s ON s.doc_id = d.doc_id AND s.slot = d.slot LEFT JOIN z ON z.doc_id = d.doc_id"
)
def embedding_slots(spark, folder):
    return embedding.slot_means(_documents(spark, folder), "doc_id", "text").select("doc_id", "slot", F.round("value", 6).alias("value"))


_BYTE = "('0x' || substr(hex(encode(t)), (2 * i + 1)::BIGINT, 2))::INT"
_SLOT = f"coalesce(list_reduce(list_transform(range(s, strlen(t), 16), lambda i: ({_BYTE} - 127)::FLOAT / 127::FLOAT), lambda a, x: a + x), 0::FLOAT) * (1::FLOAT / strlen(t)::FLOAT)"


@query(
    "SELECT doc_id, 'deterministic-hash-v1' AS model_version, CASE WHEN t = '' THEN list_transform(range(16), lambda s: 0::FLOAT) WHEN len(list_filter(v, lambda x: x <> 0)) = 0 THEN list_transform(range(16), lambda s: (CASE WHEN s = 0 THEN 1 ELSE 0 END)::FLOAT) ELSE v END AS vector, "
    f"CASE WHEN t = '' THEN 'empty_text' END AS embedding_error, NULL::INT AS bad_index FROM (SELECT doc_id, t, list_transform(range(16), lambda s: CASE WHEN strlen(t) > s THEN {_SLOT} ELSE 0::FLOAT END) AS v FROM (SELECT doc_id, {_T} AS t FROM documents WHERE text IS NOT NULL))"
)
def embed_documents(spark, folder):
    out = embedding.embed_pages(_documents(spark, folder).select("doc_id", "text"))
    return out.select("doc_id", "model_version", "vector", "embedding_error", "bad_index")


@query(
    "SELECT DISTINCT id, CASE WHEN vector IS NULL OR len(vector) <> 32 THEN 'dimension_mismatch' WHEN len(bad) > 0 THEN 'invalid_value' END AS error, CASE WHEN len(vector) = 32 AND len(bad) > 0 THEN (list_min(bad) - 1)::INT END AS bad_index "
    "FROM (SELECT id, vector, list_filter(range(1, len(vector) + 1), lambda i: vector[i] IS NULL OR NOT isfinite(vector[i])) AS bad FROM page_embeddings)"
)
def validate_embeddings(spark, folder):
    error, at = embedding.validation_error(F.lit("x"), "vector", 32)
    return once(table(spark, folder, "page_embeddings")).select("id", error.alias("error"), at.alias("bad_index"))


# ---- the queue


def _files(spark, folder):
    own = _documents(spark, folder)
    return own.select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("file_name"), F.col("source").alias("path"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"), "doc_id")


_FILES = "(SELECT 'd' || lpad(doc_id::VARCHAR, 9, '0') || '.pdf' AS file_name, sha256(text) AS sha256, doc_id FROM documents WHERE text IS NOT NULL)"


@query(f"SELECT file_name, sha256 FROM {_FILES}")
def content_hashes(spark, folder):
    return _files(spark, folder).select("file_name", "sha256")


@query(f"SELECT min(file_name) AS file_name, sha256 FROM {_FILES} GROUP BY sha256")
def first_copies(spark, folder):
    return queue.first_copies(_files(spark, folder)).select("file_name", "sha256")


@query(f"SELECT min(file_name) AS file_name, sha256 FROM {_FILES} WHERE sha256 NOT IN (SELECT sha256 FROM {_FILES} WHERE doc_id % 5 = 0) GROUP BY sha256 ORDER BY 1 LIMIT 25")
def pending_queue(spark, folder):
    own = _files(spark, folder)
    return queue.pending(own, own.where("doc_id % 5 = 0").select("sha256"), 25).select("file_name", "sha256")


@query(
    f"SELECT f.file_name, coalesce(m.document_title, f.file_name) AS document_title, m.source_label FROM {_FILES} f LEFT JOIN (SELECT 'd' || lpad(id::VARCHAR, 9, '0') || '.pdf' AS file_name, any_value(document_title) AS document_title, any_value(source_label) AS source_label FROM (SELECT DISTINCT id, document_title, source_label FROM source_documents) GROUP BY id) m USING (file_name)"
)
def manifest_join(spark, folder):
    manifest = once(table(spark, folder, "source_documents")).select(F.concat(F.lit("d"), F.lpad(F.col("id").cast("string"), 9, "0"), F.lit(".pdf")).alias("file_name"), "document_title", "source_label")
    return queue.with_manifest(_files(spark, folder), manifest).select("file_name", "document_title", "source_label")


@query(
    f"SELECT document_id, count(*) FILTER (error IS NULL) AS page_count, coalesce(sum({_chunks_sql('t')}) FILTER (error IS NULL), 0)::BIGINT AS chunk_count, list_sort(coalesce(list(page_number) FILTER (error IS NOT NULL), [])) AS failed_pages, CASE WHEN count(*) FILTER (error IS NOT NULL) = 0 THEN 'processed' ELSE 'failed' END AS status, "
    "CASE WHEN count(*) FILTER (error IS NOT NULL) = 0 THEN NULL WHEN count(*) FILTER (error IS NULL) = 0 THEN 'all_pages_failed failed_pages=' || count(*) ELSE 'partial_page_failures failed_pages=' || count(*) FILTER (error IS NOT NULL) END AS error_message "
    f"FROM (SELECT DISTINCT id, document_id, page_number, {trim_sql('text_content')} AS t, CASE WHEN coalesce(quality_score < 0.6, true) THEN 'low' END AS error FROM pages) GROUP BY document_id"
)
def document_rollup(spark, folder):
    pages = once(table(spark, folder, "pages").select("id", "document_id", "page_number", "text_content", "quality_score"))
    chosen = pages.select(F.col("document_id").alias("sha256"), "page_number", F.col("text_content").alias("text"), F.when(F.coalesce(F.col("quality_score") < 0.6, F.lit(True)), "low").alias("error"))
    return queue.document_results(chosen).select(F.col("sha256").alias("document_id"), "page_count", "chunk_count", "failed_pages", "status", "error_message")


_RESULTS = "(SELECT DISTINCT result_id, document_id, page_count, chunk_count, failed_pages FROM document_results)"


def _results(spark, folder):
    own = once(table(spark, folder, "document_results"), "result_id")
    return own.select(F.col("document_id").alias("sha256"), "chunk_count", "failed_pages", F.when(F.size("failed_pages") == 0, "processed").otherwise("failed").alias("status"))


@query(
    f"SELECT count(*) FILTER (len(failed_pages) = 0) AS processed_delta, count(*) FILTER (len(failed_pages) > 0) AS failed_delta, (sum(chunk_count) FILTER (len(failed_pages) = 0))::BIGINT AS chunks_delta, sum(len(failed_pages))::BIGINT AS page_failures_delta, "
    f"(SELECT count(DISTINCT document_id) FROM pages) AS documents_written_delta, (SELECT count(DISTINCT id) FROM pages) AS pages_written_delta FROM {_RESULTS}"
)
def run_counters(spark, folder):
    pages = once(table(spark, folder, "pages").select("id", F.col("document_id").alias("sha256")))
    row = queue.run_counters(_results(spark, folder), pages)
    return row.select("processed_delta", "failed_delta", "chunks_delta", "page_failures_delta", "documents_written_delta", "pages_written_delta")


@query(
    f"SELECT 'ingest_run processed_delta=' || count(*) FILTER (len(failed_pages) = 0) || ' failed_delta=' || count(*) FILTER (len(failed_pages) > 0) || ' chunks_delta=' || sum(chunk_count) FILTER (len(failed_pages) = 0) || ' page_failures_delta=' || sum(len(failed_pages)) "
    f"|| ' documents_written_delta=' || (SELECT count(DISTINCT document_id) FROM pages) || ' pages_written_delta=' || (SELECT count(DISTINCT id) FROM pages) || ' embeddings_written_delta=' || (SELECT count(DISTINCT id) FROM pages) "
    f"|| ' total_processed=' || (7 + count(*) FILTER (len(failed_pages) = 0)) || ' total_failed=' || (2 + count(*) FILTER (len(failed_pages) > 0)) || ' total_chunks=' || (40 + sum(chunk_count) FILTER (len(failed_pages) = 0)) "
    f"|| ' current_status=processed current_item=\"inbox/last.pdf\" failed_pages=\"a.pdf:1[2]\" db_path=\"store\"' AS line FROM {_RESULTS}"
)
def run_summary(spark, folder):
    pages = once(table(spark, folder, "pages").select("id", F.col("document_id").alias("sha256")))
    counters = queue.run_counters(_results(spark, folder), pages, {"processed": 7, "failed": 2, "chunks": 40})
    return queue.run_summary(counters, "processed", "inbox/last.pdf", "a.pdf:1[2]", "store")


@query(f"SELECT document_id, CASE WHEN document_id % 3 = 0 THEN 'cached' WHEN len(failed_pages) > 0 THEN 'failed' ELSE 'processed' END AS status FROM {_RESULTS}")
def ingest_statuses(spark, folder):
    state = F.when(F.col("status") == "failed", F.col("status"))
    return _results(spark, folder).select(F.col("sha256").alias("document_id"), queue.ingest_status(F.col("sha256") % 3 == 0, state).alias("status"))


@query(f"SELECT document_id, CASE WHEN len(failed_pages) > 0 THEN 'd' || document_id || ':' || len(failed_pages) || '[' || array_to_string(list_sort(failed_pages), '|') || ']' END AS entry FROM {_RESULTS}")
def failed_pages_summary(spark, folder):
    return _results(spark, folder).select(F.col("sha256").alias("document_id"), queue.failed_pages_entry(F.concat(F.lit("d"), "sha256"), "failed_pages").alias("entry"))


@query(f"SELECT document_id, 'ingest_progress processed=' || page_count || ' failed=' || len(failed_pages) || ' chunks=' || chunk_count || ' generated_at=x current_status=' || CASE WHEN len(failed_pages) > 0 THEN 'failed' ELSE 'none' END || ' current_item=\"' || CASE WHEN len(failed_pages) > 0 THEN 'd' || document_id || '.pdf' ELSE '' END || '\"' AS line FROM {_RESULTS}")
def status_lines(spark, folder):
    own = once(table(spark, folder, "document_results"), "result_id")
    failed = F.size("failed_pages") > 0
    return own.select("document_id", status_line(F.col("page_count"), F.size("failed_pages"), F.col("chunk_count"), F.lit("x"), F.when(failed, "failed"), F.when(failed, F.concat(F.lit("d"), "document_id", F.lit(".pdf")))).alias("line"))


@query(f"SELECT document_id FROM {_RESULTS} WHERE len(failed_pages) = 0")
def complete_documents(spark, folder):
    return _results(spark, folder).where("status = 'processed'").select(F.col("sha256").alias("document_id"))


# ---- the store: the tables as they are delivered are upserted by the later row


@query(
    "WITH d AS (SELECT *, row_number() OVER (PARTITION BY source_sha256 ORDER BY updated_at DESC) AS r FROM source_documents WHERE source_sha256 IS NOT NULL), a AS (SELECT *, id % 2 = 0 AS early FROM d WHERE r = 1), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY early ORDER BY source_sha256) AS k FROM a) "
    "SELECT (CASE WHEN early THEN k ELSE k + (SELECT count(*) FROM a WHERE early) END)::BIGINT AS id, source_url, source_sha256, source_filename, source_label, document_title, source_unit, CASE WHEN early THEN TIMESTAMP '2001-01-01' ELSE created_at END AS created_at, updated_at FROM n"
)
def upsert_documents(spark, folder):
    """Documents of even ids are stored with another label and time of creation, then all are upserted: ids and times stay, other columns are as they come, nulls too."""
    own = table(spark, folder, "source_documents").withColumn("seq", F.col("updated_at"))
    names = ["source_url", "source_sha256", "source_filename", "source_label", "document_title", "source_unit", "created_at", "updated_at", "seq"]
    documents = store.TABLES["documents"]
    early = own.where("id % 2 = 0").withColumn("source_label", F.lit("before")).withColumn("created_at", F.lit("2001-01-01 00:00:00").cast("timestamp"))
    first = store.merge(spark.createDataFrame([], documents.schema), early.select(*names), documents)
    return store.merge(first, own.select(*names), documents)


_PAGE_COLUMNS = "document_id, page_number, ocr_version, extraction_method, orientation_degrees, dpi, confidence, text_content, normalized_text_content, numeric_sanity_status, created_at, updated_at"


@query(
    "WITH p AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number, ocr_version ORDER BY updated_at DESC) AS r FROM pages), a AS (SELECT *, ocr_version = 'engine-r1' AS early FROM p WHERE r = 1), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY early ORDER BY document_id, page_number, ocr_version) AS k FROM a) "
    f"SELECT (CASE WHEN early THEN k ELSE k + (SELECT count(*) FROM a WHERE early) END)::BIGINT AS id, {_PAGE_COLUMNS} FROM n"
)
def upsert_pages(spark, folder):
    """Pages of one version are stored without their texts, then all are upserted."""
    own = table(spark, folder, "pages").withColumn("seq", F.col("updated_at")).drop("id", "language_hints")
    pages = store.TABLES["pages"]
    first = store.merge(spark.createDataFrame([], pages.schema), own.where("ocr_version = 'engine-r1'").withColumn("normalized_text_content", F.lit("before")), pages)
    return store.merge(first, own, pages).select("id", *_PAGE_COLUMNS.split(", "))


@query("SELECT page_id, model_version, max(created_at) AS created_at FROM page_embeddings GROUP BY ALL")
def upsert_embeddings(spark, folder):
    own = table(spark, folder, "page_embeddings").withColumn("seq", F.col("created_at")).drop("id")
    embeddings = store.TABLES["embeddings"]
    first = store.merge(spark.createDataFrame([], embeddings.schema), own.where("page_id % 2 = 0"), embeddings)
    return store.merge(first, own, embeddings).select("page_id", "model_version", "created_at")


def _rules_sql() -> str:
    names = {"documents": "source_documents", "pages": "pages", "embeddings": "page_embeddings"}
    missing = [f"SELECT '{t}.{c} is null' AS rule, count(*) AS n FROM {names[t]} WHERE {c} IS NULL" for t, columns in store.REQUIRED.items() for c in columns]
    return " UNION ALL ".join(missing)


@query(
    _rules_sql() + " UNION ALL "
    "SELECT 'documents.source_sha256 repeats', count(*) FROM (SELECT 1 FROM source_documents WHERE source_sha256 IS NOT NULL GROUP BY source_sha256 HAVING count(*) > 1) UNION ALL "
    "SELECT 'pages.extraction_method unknown', count(*) FROM pages WHERE NOT coalesce(extraction_method IN ('text_layer', 'vision_ocr'), false) UNION ALL "
    "SELECT 'pages key repeats', count(*) FROM (SELECT 1 FROM pages GROUP BY document_id, page_number, ocr_version HAVING count(*) > 1) UNION ALL "
    "SELECT 'pages.document_id unknown', count(*) FROM pages WHERE document_id IS NULL OR document_id NOT IN (SELECT id FROM source_documents) UNION ALL "
    "SELECT 'embeddings key repeats', count(*) FROM (SELECT 1 FROM page_embeddings GROUP BY page_id, model_version HAVING count(*) > 1) UNION ALL "
    "SELECT 'embeddings.page_id unknown', count(*) FROM page_embeddings WHERE page_id NOT IN (SELECT id FROM pages) UNION ALL "
    "SELECT 'embeddings.vector of wrong length', count(*) FROM page_embeddings WHERE vector IS NULL OR len(vector) <> 32"
)
def constraint_violations(spark, folder):
    return store.violations(table(spark, folder, "source_documents"), table(spark, folder, "pages"), table(spark, folder, "page_embeddings"), 32)


# ---- reading

_D, _P = "(SELECT DISTINCT * FROM source_documents)", "(SELECT DISTINCT ON (id) * FROM pages)"
_STATS = f"SELECT document_id, count(*) AS page_count, sum(CASE WHEN coalesce(numeric_sanity_status, 'clean') <> 'clean' THEN 1 ELSE 0 END)::BIGINT AS warning_count, round(coalesce(avg(quality_score) FILTER (NOT isnan(quality_score)), 0), 6) AS average_quality FROM {_P} GROUP BY document_id"


def _tables(spark, folder):
    return once(table(spark, folder, "source_documents")), once(table(spark, folder, "pages"))


@query(
    f"SELECT d.id, coalesce(d.document_title, d.source_filename, 'Untitled') AS title, coalesce(d.source_filename, '') AS file_name, coalesce(s.page_count, 0) AS page_count, coalesce(s.warning_count, 0) AS warning_count, coalesce(s.average_quality, 0) AS average_quality FROM {_D} d LEFT JOIN ({_STATS}) s ON s.document_id = d.id ORDER BY d.updated_at DESC, d.id DESC LIMIT 20"
)
def list_documents(spark, folder):
    return reads.list_documents(*_tables(spark, folder)).select("id", "title", "file_name", "page_count", "warning_count", F.round("average_quality", 6).alias("average_quality"))


@query(f"SELECT d.id, coalesce(s.page_count, 0) AS page_count, coalesce(s.warning_count, 0) AS warning_count, coalesce(s.average_quality, 0) AS average_quality FROM {_D} d LEFT JOIN ({_STATS}) s ON s.document_id = d.id")
def all_documents(spark, folder):
    return reads.list_documents(*_tables(spark, folder), limit=None).select("id", "page_count", "warning_count", F.round("average_quality", 6).alias("average_quality"))


@query(f"SELECT id, source_sha256, coalesce(document_title, source_filename, 'Untitled') AS title FROM {_D} WHERE id = (SELECT max(id) FROM source_documents)")
def fetch_document(spark, folder):
    documents, _ = _tables(spark, folder)
    last = documents.agg(F.max("id")).first()[0]
    return reads.fetch_document(documents, id=last).select("id", "source_sha256", "title")


@query(f"SELECT id, page_number, coalesce(numeric_sanity_status, 'clean') AS numeric_sanity_status, coalesce(normalized_text_content, text_content) AS normalized_text_content FROM {_P} WHERE document_id = 1")
def fetch_pages(spark, folder):
    _, pages = _tables(spark, folder)
    return reads.fetch_pages(pages, 1).select("id", "page_number", "numeric_sanity_status", "normalized_text_content")


@query(
    f"SELECT document_id, coalesce(string_agg(clean, chr(10) || chr(10) ORDER BY page_number, id) FILTER (clean <> ''), '') AS clean_text, coalesce(string_agg(raw, chr(10) || chr(10) ORDER BY page_number, id) FILTER (raw <> ''), '') AS raw_text FROM (SELECT id, document_id, page_number, text_content AS raw, coalesce(normalized_text_content, text_content) AS clean FROM {_P}) GROUP BY document_id"
)
def document_texts(spark, folder):
    return reads.document_texts(_tables(spark, folder)[1]).select("document_id", "clean_text", "raw_text")


@query(
    "SELECT d.id, coalesce(d.document_title, d.source_filename, 'Untitled') AS title, d.source_sha256 AS sha256, coalesce(p.page_ids, []) AS page_ids, coalesce(p.scores, []) AS scores, coalesce(p.statuses, []) AS statuses, coalesce(p.texts, []) AS texts "
    f"FROM {_D} d LEFT JOIN (SELECT document_id, list(id ORDER BY page_number, id) AS page_ids, list(round(CASE WHEN NOT isnan(quality_score) THEN quality_score END, 6) ORDER BY page_number, id) AS scores, "
    f"list(coalesce(numeric_sanity_status, 'clean') ORDER BY page_number, id) AS statuses, list(coalesce(normalized_text_content, text_content) ORDER BY page_number, id) AS texts FROM {_P} GROUP BY document_id) p ON p.document_id = d.id"
)
def structured_documents(spark, folder):
    """Each document's JSON value, read again: a score of NaN comes back as none."""
    made = reads.structured_documents(*_tables(spark, folder))
    page = "struct<id:bigint,quality_score:double,numeric_sanity_status:string,normalized_text_content:string>"
    back = made.select("id", F.from_json("payload", f"struct<document:struct<title:string,source_sha256:string>,pages:array<{page}>>").alias("p"))
    each = lambda c: F.transform("p.pages", lambda x: x[c])
    return back.select("id", F.col("p.document.title").alias("title"), F.col("p.document.source_sha256").alias("sha256"), each("id").alias("page_ids"), F.transform(each("quality_score"), lambda x: F.round(x, 6)).alias("scores"), each("numeric_sanity_status").alias("statuses"), each("normalized_text_content").alias("texts"))


@query(f"SELECT p.id, coalesce(d.document_title, d.source_filename, 'Untitled') AS title FROM {_P} p LEFT JOIN {_D} d ON d.id = p.document_id")
def pages_with_documents(spark, folder):
    documents, pages = _tables(spark, folder)
    return reads.pages_with_documents(pages, documents).select("id", "title")


@query(f"SELECT source, count(*) AS documents FROM (SELECT nullif(lower({trim_sql('source_label')}), '') AS source FROM {_D}) GROUP BY source")
def documents_by_source(spark, folder):
    return once(table(spark, folder, "source_documents")).groupBy(source_key().alias("source")).agg(F.count("*").alias("documents"))
