from __future__ import annotations

import random
import unicodedata
from collections import defaultdict

import pytest

from docforge.llm import garbled, languages, page_body, repetition, scans, site_lines
from docforge.llm.words import bare_words


def share(text: str | None, run: int = 10) -> float:
    w = bare_words(text or "", digits=False)
    seen, hit = set(), set()
    for i in range(len(w) - run + 1):
        g = tuple(w[i : i + run])
        if g in seen:
            hit.update(range(i, i + run))
        seen.add(g)
    return len(hit) / max(1, len(w))


def test_repetition_against_a_loop(spark):
    random.seed(0)
    texts = [None, "", "  \n ", "12 34 — !", "a " * 9, "a " * 10, "A, b. " * 50, "x" * 100_000, "w " * 20_000]
    for _ in range(150):
        base = [random.choice("abcdefgh") * random.randint(1, 3) for _ in range(random.randint(5, 60))]
        cut = random.randint(0, len(base))
        texts.append(" ".join(base + base[:cut] + (base if random.random() < 0.3 else [])))
    rep, n = repetition.repeated_counts(texts)
    for t, r, k in zip(texts, rep, n):
        assert r / max(k, 1) == pytest.approx(share(t)), t and t[:50]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "doc_id bigint, text string, words string")
    got = sorted(r["doc_id"] for r in repetition.repeated_texts(df).collect())
    assert got == sorted([i for i, t in enumerate(texts) if share(t) >= 0.3] * 2)
    assert repetition.repetition(df.limit(0)).count() == 0


def test_the_score_lets_all_repeated_texts_through(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("probability", __import__("pyspark").sql.functions.lit("x"))
    model = repetition.fit(df)
    exact = {r["doc_id"] for r in repetition.repetition(df).where("repeated_share >= 0.3").collect()}
    passed = {r["doc_id"]: r["probability"] for r in repetition.scored(df, model).collect()}
    assert exact and exact <= set(passed) and len(passed) < 2 * len(exact)
    assert {r["doc_id"] for r in repetition.repeated_texts(df).collect()} == exact
    assert sum(p >= 0.5 for k, p in passed.items() if k in exact) >= 0.98 * len(exact)  # calibrated: few cases are thought unlikely


def test_site_lines_against_a_loop(spark):
    random.seed(1)
    pool = ["Share this page", "SHARE  this-page!", "Légal: №", "12-34 —", "", "  ", "Ünïque", "अंतिम समीक्षा 9"]
    rows = []
    for i in range(60):
        rows.append((f"d{i}", random.choice(["hot", "hot", "b", "c", None]), "\n".join(random.choice(pool + [f"line {random.random()}"]) for _ in range(random.randint(0, 8))), "x"))
    rows += rows[:10] + [("n", "hot", None, "x"), (None, "hot", "Share this page", "x")]
    df = spark.createDataFrame(rows, "doc_id string, source_id string, clean_text string, bits string")
    docs, where = defaultdict(set), defaultdict(set)
    for d, s, t, _ in rows:
        if t is None or s is None or d is None:
            continue
        for i, line in enumerate(t.split("\n"), 1):
            k = "".join(c for c in line.lower() if unicodedata.category(c)[0] in "LM")
            if k:
                docs[s, k].add(d)
                where[s, k].add((d, i))
    want = {x for k, v in docs.items() if len(v) >= 5 for x in where[k]}
    found = site_lines.repeated_lines(df)
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    clean = {r["doc_id"]: r["clean_text"] for r in site_lines.without_lines(df, found).collect()}
    assert clean["n"] is None
    for d, s, t, _ in rows:
        if t is not None and d is not None:
            assert clean[d] == "\n".join(line for i, line in enumerate(t.split("\n"), 1) if (d, i) not in want)
    assert site_lines.repeated_lines(df.limit(0)).count() == 0


def test_site_lines_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(site_lines, "BUCKET_DOCUMENTS", 7)
    df = spark.createDataFrame([(f"d{i}", "s", f"Common\nown {chr(97 + i % 26) * (i // 26 + 1)}") for i in range(300)], "doc_id string, source_id string, clean_text string")
    got = site_lines.repeated_lines(df).collect()
    assert len(got) == 300 and {r["line_no"] for r in got} == {1}


RIGHT = ["Âmbito de aplicação do regulamento", "Ângela Merkel visitou", "Компания МегаФон сообщила", "ПриватБанк опубликовал отчёт", "Правила ВТБ24 и еврОпа", "ребёнок", "“Ñ”", "Рёбра", "“IRMÔ", "voilà\xa0»", "日本語", "æøå", "мРНК", "éèê", "Ελληνικά", "العربية", "emoji 😀", "Україна Рівне", "“Â”", "AMANHÃ? NÃO", "Łódź příští", "한국어", "中文 “字”", "İstanbul", "ГОСТ и СНиП", "Þórður Ægir"]


@pytest.mark.parametrize("t", RIGHT)
def test_names_and_other_scripts_are_left_alone(t):
    assert not garbled.garbled([t])[0] and garbled.restore(t) == t


def test_right_samples_are_left_alone(spark):
    rows = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/language_samples.parquet").select("text").collect()]
    assert not garbled.garbled(rows).any() and [garbled.restore(t) for t in rows] == rows


@pytest.mark.parametrize("t", ["日本語", "Ελληνικά γλώσσα", "العربية هنا", "see 😀 ok", "עברית", "ภาษาไทย", "한국어", "Москва"])
@pytest.mark.parametrize("page", ["latin-1", "cp1252", "cp1251", "mac_roman", "cp437", "cp850"])
def test_other_scripts_come_back(t, page):
    bad = "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in t.encode())
    assert garbled.garbled([bad])[0] and garbled.restore(bad) == t


@pytest.mark.parametrize("bad, right", [("dâ™impatto", "d’impatto"), ("â?œelectronic", "“electronic"), ("liquiditÃ resti", "liquidità resti"), ("societÃ? di", "società di"), ("рП ЪБРТПУХ Tem", "По запросу Tem"), ("оБ УТПЛ 38 МЕФ", "На срок 38 лет"), ("Ïóíêò 4764 äëÿ", "Пункт 4764 для"), ("dйlai", "délai"), ("il depositario ГЁ tenuto", "il depositario è tenuto"), ("GroГџhГ¤ndler Гјber", "Großhändler über")])
def test_traces_are_restored(bad, right):
    assert garbled.garbled([bad])[0] and garbled.restore(bad) == right


CLEAN = ["Café – naïve users", "L’émetteur à la carte", "COMUNICAÇÃO, AVALIAÇÃO; PORTUGUÊS", "créée “É” «À»", "Ünïcode ß Größe", "यदि दो विवरण", "Текст «РФ» — «АБВ» № 5", "price 5 €, 7 ₹", "plain ascii", "¿Qué? ¡Sí! señor", "à : é !"]


@pytest.mark.parametrize("t", CLEAN)
def test_right_text_is_not_garbled(t):
    assert not garbled.garbled([t])[0] and garbled.restore(t) == t


@pytest.mark.parametrize("t", ["Café – naïve “x”", "यदि दो विवरण", "Оператор платежей", "der Einführer prüft", "12 ₹ — à"])
@pytest.mark.parametrize("page", ["latin-1", "cp1252", "cp1251", "mac_roman", "cp437", "cp850"])
@pytest.mark.parametrize("times", [1, 2])
def test_wrong_pages_are_found_and_undone(t, page, times):
    bad = t
    for _ in range(times):
        raw = bad.encode()
        try:
            bad = raw.decode(page)
        except UnicodeDecodeError:
            bad = "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in raw)
    assert garbled.garbled([bad])[0]
    if page in ("latin-1", "cp1252"):
        assert garbled.restore(bad) == t


def test_traces_and_edges(spark):
    bad = ["liquidit�", "Caf\x92s", "Ïî çàïðîñó", "dйlai", "еЯКХ НАМЮПСФЕМ"]
    assert garbled.garbled([*bad, None, "", " "]).tolist() == [True] * 5 + [False] * 3
    assert garbled.restore("Ïî çàïðîñó áðîêåð") == "По запросу брокер" and garbled.restore("еЯКХ НАМЮПСФЕМ") == "Если обнаружен"
    rows = [(str(i), t, 1) for i, t in enumerate([*bad, None, "", "fine é", "ok " * 40_000 + "Ã©"])]
    df = spark.createDataFrame(rows + rows[:2], "doc_id string, clean_text string, k int")
    assert sorted(r["doc_id"] for r in garbled.garbled_records(df).collect()) == ["0", "1", "2", "3", "4", "8"]
    assert {r["doc_id"]: r["restored"][-1] for r in garbled.restored_records(df).collect()}["8"] == "é"
    assert garbled.garbled_records(df.limit(0)).count() == 0


def test_pages(spark):
    h = "content-type"
    rows = [
        (1, 200, "é".encode(), {h: "text/html; charset=utf-8"}),
        (2, 200, "é".encode("cp1252"), {"Content-Type": "text/html; charset=UTF-8"}),
        (3, 200, b'<meta charset="windows-1252">' + "“é”".encode("cp1252"), {h: "text/html"}),
        (4, 200, b'<meta charset="windows-1252">' + "“é”".encode(), {h: "text/html"}),
        (5, 200, "é".encode("cp1252"), None),
        (6, 404, b"\xff", {}),
        (7, 200, None, {}),
        (8, 200, b"", {}),
        (9, 200, "é".encode("utf-16"), {h: "text/html; charset=utf-16"}),
        (10, 200, "ab".encode("utf-16"), {h: "text/html; charset=windows-1251"}),
        (11, 200, b"plain", {h: "text/html; charset=nonsense"}),
        (12, 200, "é".encode().decode("latin-1").encode(), {h: "text/html; charset=utf-8"}),
    ]
    df = spark.createDataFrame([(a, b, None if c is None else bytearray(c), d) for a, b, c, d in rows + rows[:3]], "raw_id bigint, http_status int, content_bytes binary, headers map<string,string>")
    assert sorted(r["raw_id"] for r in garbled.garbled_pages(df).collect()) == [2, 4, 5, 10, 12]


@pytest.fixture(scope="module")
def model(spark):
    import os

    path = "/root/testdata/sf0.001/language_samples.parquet"
    if not os.path.exists(path):
        pytest.skip("no samples here")
    rows = spark.read.parquet(path).select("lang", "text").collect()
    held = [r for i, r in enumerate(rows) if i % 4 == 0]
    return languages.LanguageFilter.fit([tuple(r) for i, r in enumerate(rows) if i % 4]), held


def test_held_out_sentences(model):
    fitted, held = model
    got = [languages.assign(fitted, [r["text"]])[0] for r in held]
    right = sum(len(g) == 1 and g[0][1] == r["lang"] for g, r in zip(got, held))
    assert right >= 0.97 * len(held)


def test_languages_table(spark, model):
    fitted, held = model
    by = defaultdict(list)
    for r in held:
        by[r["lang"]].append(r["text"])
    en, fr, hi = (" ".join(by[x][:4]) for x in ("en", "fr", "hi"))
    rows = [("a", en, "en"), ("b", en, "English"), ("c", fr, "EN"), ("d", hi, None), ("e", f"{en}\n\n{fr}\n5\n{hi}", "en"), ("f", None, "en"), ("g", " \n", "en"), ("h", "12 345", "en"), ("i", hi.encode().decode("cp1252", "ignore"), "hi"), ("j", fr, "und"), ("c", fr, "EN")]
    df = spark.createDataFrame(rows, "doc_id string, clean_text string, lang string").withColumn("line_no", __import__("pyspark").sql.functions.lit(7))
    got = {(r["doc_id"], r["line_no"], r["lang"]) for r in languages.wrong_labels(languages.languages(df, fitted)).collect()}
    assert got - {x for x in got if x[0] == "i"} == {("c", 0, "fr"), ("d", 0, "hi"), ("e", 1, "en"), ("e", 3, "fr"), ("e", 4, "fr"), ("e", 5, "hi"), ("j", 0, "fr")}
    assert languages.languages(df.limit(0), fitted).count() == 0


OTHERS = {
    "zh": ["委员会应当在每年年底前向公众提交报告。", "银行必须保存客户的记录至少五年。", "本通知自公布之日起施行，并适用于所有机构。", "监管机构可以要求机构提供更多的资料。"],
    "ja": ["銀行は顧客の記録を五年間保存しなければならない。", "委員会は毎年の終わりに報告書を公表する。", "この通知は公布の日から施行される。", "監督官庁は機関に資料の提出を求めることができる。"],
    "ko": ["은행은 고객의 기록을 오 년 동안 보관하여야 한다.", "위원회는 매년 말에 보고서를 공개한다.", "이 통지는 공포한 날부터 시행한다.", "감독 기관은 자료의 제출을 요구할 수 있다."],
    "el": ["Η τράπεζα οφείλει να τηρεί τα αρχεία των πελατών για πέντε έτη.", "Η επιτροπή δημοσιεύει την έκθεση στο τέλος του έτους.", "Η παρούσα ανακοίνωση ισχύει από τη δημοσίευσή της.", "Η εποπτική αρχή μπορεί να ζητήσει περισσότερα στοιχεία."],
    "ar": ["يجب على البنك أن يحتفظ بسجلات العملاء لمدة خمس سنوات.", "تنشر اللجنة التقرير في نهاية كل سنة.", "يسري هذا الإشعار من تاريخ نشره.", "يجوز للجهة الرقابية أن تطلب المزيد من البيانات."],
}


HELD = {"zh": "银行应当每年向监管机构提交客户的资料。", "ja": "委員会は資料を保存しなければならない。", "ko": "은행은 매년 자료를 공개한다.", "el": "Η τράπεζα δημοσιεύει τα στοιχεία των πελατών.", "ar": "تنشر الجهة الرقابية البيانات في نهاية السنة."}


@pytest.fixture(scope="module")
def wider(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/language_samples.parquet").select("lang", "text").collect()]
    return languages.LanguageFilter.fit(rows + [(k, t) for k, v in OTHERS.items() for t in v])


def test_thirteen_languages_in_all_scripts(wider):
    assert len(wider.languages) == 13
    for k, v in OTHERS.items():
        for t in [*v, HELD[k]]:
            assert [x[:2] for x in languages.assign(wider, [t])[0]] == [(0, k)], t
    mixed = "\n".join([OTHERS["zh"][0], OTHERS["el"][1], "", OTHERS["ja"][2]])
    assert [x[:2] for x in languages.assign(wider, [mixed])[0]] == [(1, "zh"), (2, "el"), (4, "ja")]


def test_more_languages_than_one_plane_holds():
    random.seed(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i:03}": ["".join(random.choices(letters, k=7)) for _ in range(40)] for i in range(150)}
    model = languages.LanguageFilter.fit([(k, " ".join(w)) for k, w in own.items()])
    assert len(model.planes) == 3
    got = languages.assign(model, [" ".join(random.sample(w, 12)) for w in own.values()])
    assert [x[0][1] for x in got] == list(own)


def test_short_lines_of_a_second_language_add_up(wider):
    text = "Die Bank muss die Unterlagen der Kunden mindestens fünf Jahre lang aufbewahren.\nque la banque\npour les clients\ndans ce délai"
    assert [x[:2] for x in languages.assign(wider, [text])[0]] == [(1, "de"), (2, "fr"), (3, "fr"), (4, "fr")]
    assert languages.LanguageFilter.fit([]).languages == [] and languages.assign(languages.LanguageFilter.fit([]), ["a text"]) == [[]]


def page(items: bool = True) -> tuple[str, set[int]]:
    lines = ["Regulator", "Home", "Contact", "", "A title of the notice", "Share | Print", "10 March 2020", "The depositary shall file the annual report with the desk by the end of the year.", "A first entry of the", "A second entry of the", "The registrar may review the report in both working languages of the desk.", "Most read", "Another notice says that the", "A third one says", "© 2020 Regulator. All rights reserved.", "Back to top"]
    return "\n".join(lines), {1, 2, 3, 6, 12, 13, 14, 15, 16}


def test_main_body(spark):
    text, want = page()
    rows = [(f"d{i}", f"https://www.A.org/n/{i}", "A title of the notice", text) for i in range(6)]
    rows += [rows[0], ("x", "https://a.org/x.PDF?q=1", "t", text), ("y", None, None, None), ("z", "https://a.org/z", None, "  \n "), ("u", "https://b.org/1", None, "Only a sentence that ends here, and is long enough.")]
    df = spark.createDataFrame(rows, "doc_id string, url string, title string, body_text string")
    # six alike pages: sentences are common, too, so evidence of their form has to hold against it
    texts = {f"d{i}": text.replace("annual", "annual " + "xyzuvw"[i] * 3).replace("registrar", "registrar " + "xyzuvw"[i] * 3).replace("entry", "entry " + "xyzuvw"[i] * 3).replace("notice says", "notice " + "xyzuvw"[i] * 3).replace("third one", "third " + "xyzuvw"[i] * 3) for i in range(6)}
    df = spark.createDataFrame([(d, u, t, texts.get(d, b)) for d, u, t, b in rows], df.schema)
    got = defaultdict(set)
    for r in page_body.boilerplate_lines(df).collect():
        assert r["line_no"] not in got[r["doc_id"]]
        got[r["doc_id"]].add(r["line_no"])
    assert {k: v for k, v in got.items() if v} == {f"d{i}": want for i in range(6)}
    body = {r["doc_id"]: r["body_text"] for r in page_body.main_bodies(df).collect()}
    assert body["d0"].split("\n")[1] == "A title of the notice" and "Most read" not in body["d0"] and set(body) == {*(f"d{i}" for i in range(6)), "y", "z", "u"}
    assert page_body.boilerplate_lines(df.limit(0)).count() == 0


def test_line_classifier_follows_labels():
    import numpy as np

    rng = np.random.default_rng(1)
    kinds = [random.choice(["common", "end", "lead"]) for _ in range(3000)]
    x = page_body.line_features(["a line of some words"] * 3000, kinds, [3] * 3000, [0.1] * 3000)
    y = np.array([{"common": 0.9, "end": 0.05, "lead": 0.1}[k] for k in kinds]) > rng.random(3000)
    model = page_body.LineClassifier.fit(x, y.astype(float))
    place = list(page_body.KINDS)
    logit = {k: float(np.mean(x[[q == k for q in kinds]] @ model.weights)) for k in ("common", "end", "lead")}
    assert logit["common"] > 1.5 and logit["end"] < -2 and logit["lead"] < 0  # against its start of 4
    assert model.weights[place.index("rights")] == 5.0  # no label, no change
    assert page_body.LineClassifier().costs(["© A", "", "word"], None, [0] * 3, [0.0] * 3, [0] * 3) == [50, 0, 0]


def test_zones_of_a_page():
    data = b'<body><nav>Menu</nav><div role="main"><p>Text<br>more</p><ul><li>item</ul></div><div role="contentinfo">End</div><p>Both</p><nav>Both</nav></body>'
    assert page_body.zone_labels(["Menu", "Text more", "Text", "more", "item", "End", "Both", "none"], {}, data) == [True, None, False, False, False, True, None, None]


def test_cut_is_minimal():
    random.seed(5)
    for _ in range(200):
        n = random.randint(1, 8)
        score = [random.randint(-9, 9) for _ in range(n)]
        links = [(a, b, random.randint(0, 6)) for a in range(n) for b in range(a + 1, n) if random.random() < 0.5]

        def cost(side):
            return sum(-s if b and s < 0 else s if not b and s > 0 else 0 for b, s in zip(side, score)) + sum(w for a, b, w in links if side[a] != side[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(page_body.cut(score, links)) == best


SCAN = "The depositary shall rev1ew the annu-\nal report of the desk in the reg-\n[1]\nScanned at the Desk on request\nister. It has a long-\nterm plan and a 12th tr@nsfer.\n\nNo. 12        Some Agency\nA further re­\nport\n[2]\nScanned at the Desk on request"


def test_scan_faults(spark):
    support = "\n".join(["The depositary shall review the annual report of the desk in the register. It has a long-term plan and a 12th transfer. A further report"] * 300)
    rows = [("s", "https://a.org/x.pdf", SCAN), ("s", "https://a.org/x.pdf", SCAN), ("h", "https://a.org/x", support), ("n", "https://a.org/n.PDF", None), ("e", "https://a.org/e.pdf?x", ""), ("b", None, SCAN), ("l", "https://a.org/l.pdf", "word " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id string, url string, body_text string")
    got = sorted((r["doc_id"], r["line_no"], r["fault"]) for r in scans.faults(df).collect())
    want = [("s", 1, "hyphen"), ("s", 1, "ocr"), ("s", 2, "hyphen"), ("s", 6, "ocr"), ("s", 9, "hyphen")] + [("s", n, "furniture") for n in (3, 4, 8, 11, 12)]
    assert set(got) ^ set(want) == set() and len(got) == len(want)
    text = {(r["doc_id"], r["paragraph_no"]): r["text"] for r in scans.repaired(df).collect()}
    assert text[("s", 1)] == "The depositary shall review the annual report of the desk in the register. It has a long- term plan and a 12th transfer." and text[("s", 2)] == "A further report"
    assert scans.faults(df.limit(0)).count() == 0


def test_neighbours_choose_among_readings(spark, monkeypatch):
    support = "\n".join(["The payment fails at the gate today. A night falls over the town again."] * 400 + ["the payment fails at the gate"] * 200)
    rows = [("h", "https://a.org/x", support, 1), ("a", "https://a.org/a.pdf", "The payment fa1ls at the gate.", 1), ("b", "https://a.org/b.pdf", "A night fa1ls over the town. Night/Pa1ment and FA1LS, Fa1ls, a n1ght-town.\nThe pay-\nm3nt of the n1gh-\nt", 1)]
    df = spark.createDataFrame(rows + rows[1:2], "doc_id string, url string, body_text string, word int")
    want = {"a": "The payment fails at the gate.", "b": "A night falls over the town. Night/Pa1ment and FALLS, Falls, a night-town. The paym3nt of the night"}
    for most in (100_000, 1):
        monkeypatch.setattr(scans, "MOST_FORMS", most)
        assert {r["doc_id"]: r["text"] for r in scans.repaired(df).collect()} == want
    assert scans.corrected("1n the FA1LS; fa1ls-n1ght", {"1n": "in", "fa1ls": "falls", "n1ght": "night"}) == "in the FALLS; falls-night"


@pytest.mark.parametrize("right, good, bad", [(w, g, b) for g, b in scans.CONFUSIONS for w in ("minimal reading", "filing board", "worn clipping") if g in w])
def test_confusions_share_a_skeleton(right, good, bad):
    wrong = right.replace(good, bad, 1)
    assert scans.one_confusion(wrong, right) >= 0
    if (good, bad) not in (("b", "h"), ("h", "b"), ("g", "9")):
        assert scans.skeleton(wrong) == scans.skeleton(right)


def test_garbled_pages_are_restored(spark, tmp_path):
    from docforge.llm import queries

    html = {"Content-Type": "text/html"}
    latin, russian, hindi = "<p>Une banque « privée » — café naïf</p>", "<p>Банк обязан хранить сведения о клиентах</p>", "<p>जब तक शिकायत लंबित रहे</p>"
    said = lambda c: {"content-type": f"text/html; charset={c}"}
    rows = [
        (1, 200, latin.encode(), html, None), (2, 200, latin.encode("cp1252"), html, latin), (3, 200, latin.encode().decode("cp1252").encode(), html, latin), (4, 200, latin.encode("cp1252"), said("windows-1251"), latin),
        (5, 200, latin.encode(), said("iso-8859-1"), latin), (6, 200, russian.encode("cp1251"), said("koi8-r"), russian), (7, 200, russian.encode("cp1251"), html, russian), (8, 200, russian.encode("utf-16"), html, russian),
        (9, 200, hindi.encode(), said("windows-1252"), hindi), (10, 404, latin.encode("cp1252"), html, None), (11, 200, russian.encode("utf-16-le"), html, russian), (12, 200, russian.encode("cp1251"), said("windows-1251"), None),
        (13, 200, hindi.encode() + b"<p>Caf\xe9</p>", html, hindi + "<p>Café</p>"),
    ]
    raw = [(k, s, bytearray(b), h) for k, s, b, h, _ in rows]
    spark.createDataFrame(raw + raw[:2], "raw_id bigint, http_status int, content_bytes binary, headers map<string,string>").write.parquet(str(tmp_path / "raw_documents.parquet"))
    spark.createDataFrame([("r1", "CafÃ©"), ("r2", "plain")], "doc_id string, clean_text string").write.parquet(str(tmp_path / "document_records.parquet"))
    got = queries.p4_restored(spark, str(tmp_path)).collect()
    assert len({(r["kind"], r["row_key"]) for r in got}) == len(got)
    assert {(r["kind"], r["row_key"]): r["restored"] for r in got} == {("raw", str(k)): t for k, *_, t in rows if t} | {("record", "r1"): "Café"}
    assert {(r["kind"], r["row_key"]) for r in got} == {(r["kind"], r["row_key"]) for r in queries.p4_found(spark, str(tmp_path)).collect()}


def test_main_bodies_of_pages_not_parsed_yet(spark):
    import datetime as dt
    import hashlib

    def notice(i):
        return [f"The notice of desk {'abcdefgh'[i] * 4}", f"The depositary {'abcdefgh'[i] * 5} shall file the annual report with the desk by the end of the year.", f"A registrar {'ghijklmn'[i] * 5} keeps all records of clients for at least five years after that."]

    side = ["Regulator", "Home", "Contact", "Most read", "All rights reserved"]
    at = dt.datetime(2024, 1, 1)
    ids = [hashlib.sha256(f"https://a.org/n/{i}|2024-01-01T00:00:00+00:00".encode()).hexdigest()[:16] for i in range(8)]
    html = lambda i: f"<html><head><title>{notice(i)[0]} | Regulator</title><style>p{{}}</style></head><body><div>Regulator</div><ul><li>Home<li>Contact</ul><main><h1>{notice(i)[0]}</h1><p>{notice(i)[1]}</p><p>{notice(i)[2]}</p></main><div>Most read</div><div>All rights reserved</div></body></html>"
    parsed = spark.createDataFrame([(ids[i], f"https://a.org/n/{i}", notice(i)[0], "\n".join(side[:3] + notice(i) + side[3:])) for i in range(6)], "doc_id string, url string, title string, body_text string")
    raw = [(f"https://a.org/n/{i}", at, 200, bytearray(html(i).encode()), {"Content-Type": "text/html"}) for i in (0, 6, 6)] + [("https://a.org/n/7", at, 200, bytearray(html(7).encode("utf-16")), {}), ("https://a.org/x.pdf", at, 200, bytearray(b"%PDF-1.4"), {}), ("https://a.org/n/9", at, 404, bytearray(b"<p>Not found</p>"), {})]
    raw += [("https://a.org/n/0", at + dt.timedelta(days=k), 200, bytearray(html(0).encode()), {"Content-Type": "text/html"}) for k in range(1, 5)]
    again = {hashlib.sha256(f"https://a.org/n/0|2024-01-0{k + 1}T00:00:00+00:00".encode()).hexdigest()[:16] for k in range(1, 5)}
    raw = spark.createDataFrame(raw, "url string, fetched_at timestamp, http_status int, content_bytes binary, headers map<string,string>")
    got = [tuple(r) for r in page_body.main_bodies(parsed, raw).collect()]
    assert sorted(got) == sorted([(k, "\n".join(notice(i))) for i, k in enumerate(ids)] + [(k, "\n".join(notice(0))) for k in again])
