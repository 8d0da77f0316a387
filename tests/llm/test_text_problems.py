import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import canon, charlm, language, lines, scans, spam

PAGE = "id bigint, document_id bigint, page_number int, extraction_method string, text_content string, normalized_text_content string, quality_score double, language_hints array<string>, source_label string, confidence double"


def pages(spark, rows):
    """Rows are (id, document_id, text) with defaults; source_label is a column of no meaning here."""
    return spark.createDataFrame([(i, d, 1, "vision_ocr", t, None, 0.5, None, "clash", None) for i, d, t in rows], PAGE)


# ---- problem 6


def brute(text):
    plain = canon.tables()[0]
    t = unicodedata.normalize("NFC", "".join(plain.get(c, c) for c in text))
    return " ".join(t.split())


ODD = "аеоΑΟﬁＡ１　 ​ȩ́̂éï️­ا‍لﻻ가ᄀ\x00\x1f😀'\\$"


def test_canonical_equals_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ODD + "abc é \n") for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range(300)] + ["", " ", None, "x" * 200_000, "é" * 50_000, "é" * 20_000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, text string, canonical string")
    got = {r.id: r for r in canon.canonical(df, ["id"], "text").select("id", "canonical", canon.skeleton("canonical").alias("s")).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert (got[i].s if t is not None else got[i].canonical) == (brute(t) if t is not None else None), repr(t)[:200]


def test_canonical_is_stable(spark):
    df = spark.createDataFrame([(0, ODD * 3)], "id int, text string")
    once = canon.canonical(df, ["id"], "text").withColumnRenamed("canonical", "text")
    assert once.first().text == canon.canonical(once, ["id"], "text").first().canonical


def test_words_keep_their_script(spark):
    russian, greek, latin = "Это обычная русская страница, а не он один", "Αυτή είναι μια σελίδα ΚΑΙ όχι άλλη", "The annual report, a note"
    hidden = russian.replace("о", "o").replace("а", "a")
    spoofed = latin.replace("a", "а").replace("e", "е")
    df = spark.createDataFrame(list(enumerate([russian, greek, latin, hidden, spoofed, f"{latin} «{russian}» and {latin}"])), "id int, text string")
    got = {r.id: r.canonical for r in canon.canonical(df, ["id"], "text").collect()}
    assert [got[i] for i in range(6)] == [russian, unicodedata.normalize("NFC", greek), latin, russian, latin, f"{latin} «{russian}» and {latin}"]
    again = canon.canonical(spark.createDataFrame(list(got.items()), "id int, text string"), ["id"], "text")
    assert {r.id: r.canonical for r in again.collect()} == got


def test_look_alike_members_say_what_pairs_say(spark, monkeypatch):
    base = "The annual statement of the harbour office lists twelve vessels and their cargo"
    rows = [(i, 1, base.replace("a", "а") if i % 3 == 0 else base.replace(" ", "  ") if i % 7 == 0 else base) for i in range(40)] + [(50, 1, base + "."), (51, 1, "short")]
    members = {r.page_id: r for r in canon.look_alike_members(pages(spark, rows)).collect()}
    assert set(members) == {*range(40), 50} and members[50].texts == 1 and members[5].texts == 3 and {members[i].look_id for i in range(40)} == {0}
    monkeypatch.setattr(canon, "PAIR_ROWS", 7)
    pairs = sorted(tuple(r) for r in canon.look_alike_pairs(pages(spark, rows)).collect())
    assert pairs == sorted((a, b) for a in members for b in members if a < b and members[a].look_id == members[b].look_id and members[a].text_id != members[b].text_id)


def test_look_alike_pairs(spark):
    base = "The annual statement of the harbour office lists twelve vessels and their cargo"
    rows = [(1, 1, base), (2, 1, base.replace("a", "а")), (3, 1, base), (3, 1, base), (4, 2, base.replace(" ", "  ", 3)), (5, 2, base + "."), (6, 2, None), (7, 2, "short а"), (8, 2, "short a"), (9, 2, "")]
    got = {tuple(r) for r in canon.look_alike_pairs(pages(spark, rows)).collect()}
    assert got == {(1, 2), (2, 3), (1, 4), (2, 4), (3, 4)}
    assert canon.look_alike_pairs(pages(spark, [])).count() == 0


# ---- problem 1


def test_probabilities_sum_to_one():
    model = charlm.Model(["a", "b"], {"a": ["abracadabra abra cadabra"] * 3, "b": ["barbara rhubarb bar"] * 2})
    # over the characters that the models know, and one that stands for all others
    known = "abcdrhu "
    for context in ("abr", "bar", "zzz", "ra "):
        for k in range(2):
            total = 0.0
            for c in known + "é":
                e, _ = model.entropies([context + c])
                before, _ = model.entropies([context])
                total += float(2.718281828 ** -(e[0, k] * 4 - before[0, k] * 3))
            assert total == pytest.approx(1, abs=0.02), (context, k)


EN = ["the harbour office will publish the report before the end of march", "nothing in this form changes the way the company measures its stock", "we expect that the pumps and valves are replaced every twelve weeks", "the technician should call the works before touching the switch"]
FR = ["le bureau du port publiera le rapport avant la fin du mois de mars", "rien dans ce formulaire ne change la façon dont la société mesure son stock", "nous pensons que les pompes et les vannes sont remplacées chaque semaine", "le technicien doit appeler l'atelier avant de toucher au bouton rouge"]


def language_tables(spark):
    rows, i = [], 0
    for hints, words in ((["en"], EN), (["fr-FR"], FR)):
        for k in range(30):
            i += 1
            # every tenth label is wrong
            label = hints if k % 10 else (["fr"] if hints == ["en"] else ["en"])
            rows.append((i, i, 1, "text_layer", " ".join(words[(k + j) % 4] for j in range(3)) + "\n \n" + words[k % 4], None, 0.5, label, None))
    mixed = [
        (101, 500, 1, "text_layer", " ".join(EN[:2]) + "\n\t\n" + " ".join(FR[:2]), None, 0.5, ["fr"], None), (102, 501, 1, "text_layer", " ".join(FR[:2]), None, None, None, None), (103, None, None, None, None, None, None, None, None),
        (104, 502, 1, "text_layer", "", None, 0.5, [None, " "], None), (105, 503, 1, "text_layer", "1234 5678\n\nqzx wkrt pfgh jjkl zzzx qqwv " * 4, None, 0.5, ["en"], None), (101, 500, 1, "text_layer", " ".join(EN[:2]) + "\n\t\n" + " ".join(FR[:2]), None, 0.5, ["fr"], None),
    ]
    configs = spark.createDataFrame([(1, ["FR-fr", " "]), (2, []), (3, None)], "run_id int, languages array<string>")
    results = spark.createDataFrame([(1, 1, 501), (2, 2, 500), (3, None, None)], "result_id bigint, run_id int, document_id bigint").withColumn("finished_at", F.current_timestamp())
    return spark.createDataFrame([(*r, None) for r in rows + mixed], PAGE), results, configs


def test_languages(spark):
    own, results, configs = language_tables(spark)
    segments, labels = language.identify(own, results, configs)
    got = {(r.page_id, r.segment_no): (r.lang, r.confidence) for r in segments.collect()}
    assert got[101, 1][0] == "en" and got[101, 2][0] == "fr" and got[101, 1][1] > 0.9
    assert got[105, 1] == (None, 0.0) and 103 not in {k[0] for k in got} and 104 not in {k[0] for k in got}
    right = sum(got[i, 1][0] == ("en" if i <= 30 else "fr") for i in range(1, 61))
    assert right == 60  # the wrong labels don't count
    found = {tuple(r) for r in language.mislabelled(segments, labels).collect()}
    assert (101, 1, "en") in found and (101, 2, "fr") not in found and not any(f[0] == 102 for f in found)
    by_page = {r.page_id: r for r in language.page_languages(own, segments).collect()}
    assert by_page[101].lang == "fr" or len(by_page[101].segments) == 2
    assert by_page[103].lang is None and by_page[104].segments == []


def test_languages_of_an_empty_table(spark):
    own, results, configs = language_tables(spark)
    segments, labels = language.identify(own.limit(0), results, configs)
    assert language.mislabelled(segments, labels).count() == 0


# ---- problem 4


def test_repeated_lines(spark):
    notice, rare = "Share this page with — COLLEAGUES today!", "A line that stands in three documents only"
    rows = [(i, i, f"own text of page number {i} and more\n{notice if i < 6 else 'x'}\n{rare if i < 3 else ''}\nshort") for i in range(60)]
    rows += [(0, 0, rows[0][2]), (100, 3, "share this page with colleagues today"), (101, 999, notice), (102, None, notice), (103, 4, None), (104, 4, "")]
    documents = spark.createDataFrame([(i, " Harbour " if i % 2 else "HARBOUR", None) for i in range(60)] + [(0, "HARBOUR", None), (999, None, None)], "id bigint, source_label string, text_content string")
    found, repeated = lines.lines_to_remove(pages(spark, rows), documents)
    assert {tuple(r) for r in found.collect()} == {(i, 2) for i in range(6)} | {(100, 1)}
    assert [(r.in_docs, r.n_docs) for r in repeated.collect()] == [(6, 60)]
    clean = {r.page_id: r for r in lines.without_lines(pages(spark, rows), found).collect()}
    assert clean[0].text == f"own text of page number 0 and more\n{rare}\nshort" and clean[0].n_removed == 1
    assert clean[100].text == "" and clean[103].text is None and clean[104].text == "" and clean[101].n_removed == 0 and len(clean) == 65


def test_lines_common_to_all_sources_stay(spark):
    common, own = "This notice stands in documents of all sources alike", "This notice stands in documents of the harbour only"
    rows = [(i, i, f"{common if i % 10 < 3 else 'x'}\n{own if i < 30 else 'y'}") for i in range(200)]
    documents = spark.createDataFrame([(i, "harbour" if i < 100 else "mill") for i in range(200)], "id bigint, source_label string")
    found, repeated = lines.lines_to_remove(pages(spark, rows), documents)
    assert sorted((r.source, r.in_docs, r.all_docs, r.ratio > 0, r.significant, r.excess) for r in repeated.collect()) == [("harbour", 30, 30, True, True, True), ("harbour", 30, 60, False, False, True), ("mill", 30, 60, False, False, True)]
    assert {tuple(r) for r in found.collect()} == {(i, 2) for i in range(30)}


def test_a_line_commoner_outside_stays(spark):
    line = "This notice is commoner in documents of the mill than in the harbour's"
    rows = [(i, i, line if i < 10 or 100 <= i < 180 else "x") for i in range(200)]
    documents = spark.createDataFrame([(i, "harbour" if i < 100 else "mill") for i in range(200)], "id bigint, source_label string")
    found, repeated = lines.lines_to_remove(pages(spark, rows), documents)
    assert {(r.source, r.significant, r.excess) for r in repeated.collect()} == {("harbour", False, True), ("mill", True, True)}
    assert {r.page_id for r in found.collect()} == set(range(100, 180))
    # without any document outside, the rule decides
    alone = documents.where("id < 100")
    assert {r.page_id for r in lines.lines_to_remove(pages(spark, rows[:100]), alone)[0].collect()} == set(range(10))


def test_repeated_lines_of_empty_tables(spark):
    documents = spark.createDataFrame([], "id bigint, source_label string")
    assert lines.lines_to_remove(pages(spark, []), documents)[0].count() == 0


# ---- problem 3

WORDS = "the technician should replace every filter before winter and report each deviation to the works office which keeps the current schedule of harbour repairs in order".split()


def scan_tables(spark):
    rng = random.Random(3)
    clean = [(1000 + i, 90, 1, "text_layer", " ".join(rng.choice(WORDS) for _ in range(150)) + " long-term plan 31,250 AB-12345", None, 0.5, None, None) for i in range(20)]
    rows, truth = [], set()
    for i in range(60):
        title, body = f"Harbour Report QX-{10000 + i}", []
        for k in range(8):
            body.append(" ".join(rng.choice(WORDS) for _ in range(14)))
        body[2] += " devia-"
        body[3] = "tion " + body[3]
        body[4] += " long-"
        body[5] = "term " + body[5]
        body[6] += " rcport 3l,250"
        text = "\n".join([title if i % 2 else f"{title}   {i + 1}", "", *body, "", f"- {i + 1} -"])
        rows.append((i, i, i + 1, "vision_ocr", text, None, 0.5, None, None))
        truth |= {(i, 1, "furniture"), (i, 12, "furniture"), (i, 5, "broken"), (i, 9, "misread")}
    edge = [(200, None, None, "vision_ocr", "", None, None, None, None), (201, None, None, "vision_ocr", None, None, None, None, None), (202, 5, 1, "vision_ocr", "word " * 60_000, None, None, None, None), rows[0]]
    documents = spark.createDataFrame([(i, f"Harbour Report QX-{10000 + i}", None) for i in range(60)] + [(90, None, None)], "id bigint, document_title string, text_content string")
    return spark.createDataFrame([(*r, 0.6) for r in clean + rows + edge], PAGE), documents, truth


def test_scans(spark):
    own, documents, truth = scan_tables(spark)
    cleaned = scans.clean_pages(own, documents)
    by_page = {r.page_id: r for r in cleaned.collect()}
    found = {tuple(r) for r in scans.noisy_lines(cleaned).collect()}
    assert found == truth
    text = by_page[3].text
    assert "\n" not in text and "deviation" in text and "long- term" in text.replace("long-term", "long- term") and "report 31,250" in text and "Harbour" not in text
    assert by_page[200].text == "" and 201 not in by_page and by_page[202].misread == []
    assert scans.clean_pages(own.limit(0), documents).count() == 0


def test_scans_of_another_generator(spark):
    """Pages that look otherwise than those of the test tables, with a confusion that no list names."""
    rng = random.Random(11)
    syllables = [a + b for a in "b d f g k l m n p r s t v z".split() for b in "a e i o u an er il on us".split()]
    words = sorted({"".join(rng.choice(syllables) for _ in range(rng.choice([2, 3, 3, 4]))) for _ in range(600)})
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = [(5000 + i, 900, 1, "text_layer", "\n".join(sentence(12).capitalize() + "." for _ in range(25)), None, 0.5, None, None, None) for i in range(60)]
    rows, truth, documents = [], set(), []
    for i in range(150):
        title = f"{sentence(3).title()} {1990 + i % 30}"
        documents.append((i, title if i % 10 else None, None))
        lines, noisy = [], []
        style, number = i % 3, i % 17 + 1
        if style == 0:
            noisy.append((len(lines), "furniture"))
            lines += [title.upper(), "", ""]
        elif style == 1:
            noisy.append((len(lines), "furniture"))
            lines += [f"{number}    {title}", ""]
        for k in range(12):
            line = sentence(9)
            if rng.random() < 0.2:
                w = rng.choice([x for x in words if len(x) >= 6])
                noisy.append((len(lines), "broken"))
                cut = rng.randrange(2, len(w) - 2)
                lines += [f"{line} {w[:cut]}-", f"{w[cut:]} {sentence(6)}"]
                continue
            at = rng.randrange(9)
            w = line.split()[at]
            if rng.random() < 0.15 and len(w) >= 6 and "v" in w and w.replace("v", "y", 1) not in words:
                line = " ".join([*line.split()[:at], w.replace("v", "y", 1), *line.split()[at + 1 :]])
                noisy.append((len(lines), "misread"))
            lines.append(line)
            if k == 5:
                lines.append("")
        if style:
            lines += ["", f"Page {number} of 40" if style == 1 else f"- {number} -"]
            noisy.append((len(lines) - 1, "furniture"))
        rows.append((i, i, number, "vision_ocr", "\n".join(lines), None, 0.5, None, None, 0.3))
        truth |= {(i, n + 1, kind) for n, kind in noisy}
    own = spark.createDataFrame(clean + rows, PAGE)
    found = {tuple(r) for r in scans.noisy_lines(scans.clean_pages(own, spark.createDataFrame([*documents, (900, None, None)], "id bigint, document_title string, text_content string"))).collect()}
    for kind in ("furniture", "broken", "misread"):
        right, got = {t for t in truth if t[2] == kind}, {f for f in found if f[2] == kind}
        print(kind, len(right), len(got), len(right & got))
        assert len(right & got) >= 0.95 * len(right) and len(right & got) >= 0.95 * len(got), (kind, sorted(right - got)[:3], sorted(got - right)[:3])


def test_confusions_come_from_all_words(spark):
    """More confusions than a list of 400 would hold, each borne out by as many words as it must be, and some that it goes both ways."""
    rng = random.Random(3)
    letters = "bcdfghjklmnpqrstvwxz"
    # known words differ in many places, so that a word has a single one that it may be
    stems = iter({"".join(rng.choice("aeiou" + letters) for _ in range(12)) for _ in range(4000)})
    pairs = rng.sample([(a, b + c) for a in "áéíóúý" for b in letters for c in letters], 450)
    known, unknown = [], []

    def bear_out(a, b, n):
        for _ in range(n):
            stem = next(stems)
            known.append((stem[:6] + b + stem[6:], 9))
            unknown.append((stem[:6] + a + stem[6:],))

    for a, b in pairs:
        bear_out(a, b, scans.SUPPORT)
    bear_out("ñ", "ç", scans.SUPPORT - 1)
    bear_out("ő", "ű", 7)
    bear_out("ű", "ő", 2)
    learnt = scans.confusions(spark.createDataFrame(unknown, "key string"), spark.createDataFrame(known, "key string, n long"))
    assert {(a, b) for a, rights in learnt.items() for b in rights} == {*scans.MISREAD, *pairs}


def test_confusions_need_their_part_of_all_words(spark, monkeypatch):
    monkeypatch.setattr(scans, "SUPPORT_SHARE", 0.3)
    known = [(f"{c}stem{c}{right}{c}ending", 2) for c, right in zip("abcdefghijklmnop", "xxxxyyyyyzzzzzzz", strict=True)]
    unknown = [(w.replace("x", "é").replace("y", "ó").replace("z", "ú"),) for w, _ in known]
    learnt = scans.confusions(spark.createDataFrame(unknown, "key string"), spark.createDataFrame(known, "key string, n long"))
    assert [learnt.get(a) for a in "éóú"] == [None, ["y"], ["z"]]


def test_line_model_is_fitted_on_all_blocks(spark):
    own, documents, _ = scan_tables(spark)
    # one block, and a block in each of 40 partitions
    models = [scans.prepare(p, documents)[1] for p in (own.coalesce(1), own.repartition(40, "id"))]
    assert models[0].clean_rate == models[1].clean_rate and (models[0].rates == models[1].rates).all()
    assert (models[0].start == models[1].start).all() and (models[0].step == models[1].step).all()
    assert all((a == b).all() for a, b in zip(models[0].emit, models[1].emit, strict=True))


def test_tally_counts_line_by_line():
    rng = np.random.default_rng(1)
    pages, labels = [], []
    for size in [1, 0, 5, 30, 1, 200]:
        states = rng.integers(0, 4, size)
        lines = np.array([[-1] * 6 if s == scans.BLANK else [rng.integers(0, n) for n in scans.FEATURES] for s in states], np.int64).reshape(-1, 6)
        pages.append(lines)
        labels.append(states)
    start, step, emit = np.zeros(4, int), np.zeros((4, 4), int), [np.zeros((3, n), int) for n in scans.FEATURES]
    for lines, states in zip(pages, labels, strict=True):
        for i, s in enumerate(states):
            if i:
                step[states[i - 1], s] += 1
            else:
                start[s] += 1
            for k, v in enumerate(lines[i]):
                if s != scans.BLANK:
                    emit[k][s, v] += 1
    assert scans.tally(pages, labels).tolist() == [*start, *step.ravel(), *(v for e in emit for v in e.ravel())]
    assert scans.tally(pages[:2], labels[:2]).sum() == scans.tally(pages[:1], labels[:1]).sum() and not scans.tally([], []).any()


# ---- problem 10


def test_spam(spark):
    rng = random.Random(8)
    sentence = lambda: " ".join(rng.choice(WORDS) + str(rng.randrange(9)) * (rng.random() < 0.1) for _ in range(12)).capitalize() + "."
    clean = [(i, " ".join(sentence() for _ in range(12)), "en") for i in range(80)]
    bad = [
        (900, "cheap toner, " * 80, "en"), (901, "\n".join(f"http://shop{i}.example/item/{rng.randrange(10**5)}" for i in range(40)), None), (902, "\n".join(f"QX-{rng.randrange(10000, 99999)} | red | shelf | XL | grey" for _ in range(30)), "xx"),
        (903, "Looking for toner? Our toner is the toner you want. " * 30, "en"),
    ]
    figures = "\n".join(f"item {i} .... {rng.randrange(10**6):,} .... {rng.randrange(10**6):,}" for i in range(30))
    good = [(800, figures, "en"), (801, None, None), (802, "", "en"), (803, "toner toner", "en"), (804, " ".join(sentence() for _ in range(400)), "en"), (800, figures, "en")]
    df = spark.createDataFrame(clean + bad + good, "doc_id bigint, text string, lang string").withColumn("spam", F.lit("clash"))
    out = spam.keyword_spam(df)
    assert out.count() == len(clean) + len(bad) + len(good)
    assert {r.doc_id for r in out.where("spam").collect()} == {900, 901, 902, 903}
    assert spam.keyword_spam(df.limit(0)).count() == 0
