"""Row-wise operators: quality, personal data, chat, language, toxicity."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rsvpflow.llm import chat, language, private, quality, queries, toxicity
from rsvpflow.llm.batches import crc_mod
from tests.conftest import SF_SMALL
from tests.llm.helpers import crc, doc_words, docs_table, hard_rows

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- quality

def plain_quality(text):
    ws = doc_words(text)
    t = text or ""
    win = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    many = {w for w in win if win.count(w) > 1} if len(win) < 3000 else {w for w, n in __import__("collections").Counter(win).items() if n > 1}
    hit = {j for i, w in enumerate(win) if w in many for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if doc_words(line):
            dup += line in seen
            seen.add(line)
    n = len(ws)
    return (n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n)


@pytest.mark.parametrize("clash", [False, True])
def test_quality_counts_equal_plain_version(spark, clash):
    rng = random.Random(5)
    rows = hard_rows() + [(100 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(300 + i, "\n".join(" ".join(rng.choice(["x |", "y", "z$", "w"]) for _ in range(rng.randint(0, 9))) for _ in range(8))) for i in range(30)]
    got = sorted(map(tuple, quality.quality_rules(docs_table(spark, rows, clash)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()), key=str)
    assert got == sorted(((i, *plain_quality(t)) for i, t in rows), key=str)


def test_quality_of_nothing(spark):
    assert quality.quality_rules(docs_table(spark, hard_rows()).limit(0)).count() == 0


def test_quality_on_documents(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_quality(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(rows[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_line_rules():
    judge = lambda s: quality.bad_line(s, s.encode().split())
    assert judge("Home | About | Contact | Imprint")
    assert judge("All rights reserved.")
    assert judge("BUY!! NOW!! ONLY!! TODAY!!")
    assert judge("*** ### ***")
    assert judge("Read more")
    assert not judge("The committee met on Tuesday and agreed, after some debate, on the plan.")
    assert not judge("Eine Zeile ohne Punkt am Ende, aber lang genug für einen Absatz im Text")


# ---------------------------------------------------------------- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = digits(m.group())
        total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_patterns_on_random_text():
    rng = random.Random(2)
    for alphabet in ("a@.-", "0.12@a ", "+10 ()-.", "4012 -8", "a1@.+ (-)%_"):
        for _ in range(3000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert private.base_spans(t) == plain_spans(t), t


def test_private_query_equals_patterns_and_keeps_base(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op4_private(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain_spans(texts[r.doc_id])
        named = [f"{private.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(","))


def test_private_adds_spans_and_survives_hard_rows(spark):
    near = [(100 + i, f"Contact us by e-mail: jane.doe{i} [at] example{i}.org or call +1 (555) 010-99{i:02d} today. Mail bob{i}@example.com now.") for i in range(40)]
    got = {r.doc_id: r for r in private.personal_data(docs_table(spark, hard_rows() + near, True)).collect() if r.doc_id}
    assert got[100].n_email == 1 and got[100].n_phone == 1 and got[100].n_spans == 3
    assert got[2].spans == "" and got[1].n_spans == 0
    assert private.personal_data(docs_table(spark, hard_rows()).limit(0)).count() == 0


# ---------------------------------------------------------------- chat

def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["<|turn|>", "<|text|>", "<|end|>", "<|", "\\", "\\x3c|", "\\\\", " ", "\n", "é", "\U0001f600", "a", "don't", "  x", "</s>", "[INST]", "assistant", "́"]
    rows = []
    for c in range(120):
        for t in range(rng.randint(1, 6)):
            text = None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", "<|end|>", None]), text, 5))
    rows += [(None, 0, "assistant", "no id", 1), (500, None, "user", "no turn", 1), (501, 1, "assistant", "twice", 1), (501, 1, "assistant", "twice", 1),
             (502, 0, "assistant", "long " * 30000, 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids long")
    full = chat.format_chat(table, queries.tokenizer_path("byte_bpe_50k.json"))
    got = {r.conv_id: r for r in chat.read_back(full).collect()}
    want = {}
    for c, t, role, text, _ in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [(x[3], x[5]) for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in full.limit(50).collect():
        spans = chat.render(chat.parse(r.formatted))
        assert spans[0] == r.formatted and len(r.ids) == len(r.loss_mask)
        for s, e, m in zip(r.starts, r.ends, r.loss_mask):  # every token lies in one turn or outside of all
            assert m == any(a <= s and e <= b for a, b in spans[1])
    assert chat.read_back(chat.format_chat(table.limit(0), queries.tokenizer_path("byte_bpe_50k.json"))).count() == 0


def test_chat_query(spark):
    got = {r.conv_id: r for r in queries.op9_chat(spark, SF_SMALL).collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len("</s>[INST] ok [/INST]")
    assert len(got) == 1 + spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id").distinct().count()


# ---------------------------------------------------------------- language

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op1_language(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_hard_rows(spark):
    rows = [(i, "the cat and the dog of the house", "en") for i in range(40)] + [(100 + i, "der hund und die katze in dem haus", "de") for i in range(40)]
    docs = docs_table(spark, rows + [r + (None,) for r in hard_rows()], True)
    model = language.fit(docs, F.lit(True))
    out = language.identify(docs, model).collect()
    assert len(out) == len(rows) + len(hard_rows())
    got = {r.doc_id: r for r in out}
    assert got[100].lang_pred == "de" and got[41 - 40 + 15].lang_pred == "en"
    assert got[-3].lang_pred in ("en", "de")
    und = [r for r in out if r.lang_pred == "und"]
    assert sorted(str(r.doc_id) for r in und if r.doc_id not in range(40))[:1] == ["None"] and all(r.score == 0 and not r.accepted for r in und)
    assert language.fit(docs.limit(0), F.lit(True)) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_language_needs_a_letter(spark):
    """Fractions, superscripts and enclosed or Roman numerals are no letters."""
    rows = [(i, "the cat and the dog of the house", "en") for i in range(40)] + [(100 + i, "der hund und die katze in dem haus", "de") for i in range(40)]
    texts = ["½ ²", "① Ⅷ", "12 _ ½", "½ é", "ª", "中"]
    docs = docs_table(spark, rows + [(200 + n, t, "en") for n, t in enumerate(texts)])
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs, F.col("doc_id") < 200)).collect()}
    assert [got[200 + n] == "und" for n in range(len(texts))] == [not any(map(str.isalpha, t)) for t in texts]


def test_subwords_cross_no_blank():
    for text in ("a bc def ghij", "é ü", ""):
        body = language.clean(text)
        want = sum(1 for n in (2, 3, 4) for i in range(len(body) - n + 1) if b" " not in body[i + 1:i + n - 1] and body[i:i + n] != b"  ")
        assert len(language.subwords([body])[0]) == want


# ---------------------------------------------------------------- toxicity

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in got)
    pos, neg = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.95, auc
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in held) > 0.97 * len(held)


def test_block_max_search_is_exact():
    import numpy as np

    rng = random.Random(4)
    vecs = [{t: rng.randint(1, 3) for t in rng.sample(range(30), rng.randint(1, 6))} for _ in range(400)]
    index = toxicity.Index(vecs, list(range(400)), [i % 2 for i in range(400)], np.array([1 + i / 30 for i in range(30)]))
    order = {i: p for p, i in enumerate(index.ids)}
    for _ in range(60):
        q = {t: 1 for t in rng.sample(range(30), 3)}
        w = index.weigh(q)
        sims = []
        for i, v in enumerate(vecs):
            x = index.weigh(v)
            s = round(sum(w[t] * x[t] for t in sorted(w) if t in x), 12)
            if s > 0:
                sims.append((-s, order[i]))
        got, want = index.nearest(q, 10), sorted(sims)[:10]
        assert [round(s, 9) for s, _ in got] == [round(-s, 9) for s, _ in want]


def test_toxicity_rare_words_and_copies(spark):
    rng = random.Random(18)
    plain = lambda: " ".join(rng.choice(["sun", "tree", "road", "lake", "hill", "rain"]) for _ in range(20))
    rows = [(i, plain() + (" vile" if i % 3 == 0 else "")) for i in range(300)]
    odd = {300 + i: " ".join("".join(rng.choice("bcdfghjklm") for _ in range(9)) for _ in range(8)) for i in range(20)}  # words of a single example each
    rows += list(odd.items()) + [(i + 100, t) for i, t in odd.items()] + [(500, "nothing known")]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0 or i >= 300)) for i, _ in rows if i < 320], "doc_id long, quality int, toxic int")
    docs = docs_table(spark, rows)
    model = toxicity.fit(docs, labels, F.lit(True))
    by = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    inside = set(model.index.ids) & set(odd)
    assert len(inside) > 5
    for i in inside:  # copies of labelled toxic examples, in words that no other example has
        assert by[i + 100].predicted == 1 and by[i + 100].evidence[0] == i and by[i + 100].similarity > 0.999
    assert not {i + 100 for i in inside} & {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert by[500].similarity == 0


def test_toxicity_hard_rows(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["sun", "tree", "road", "lake"]) for _ in range(20)) + (" vile" if i % 3 == 0 else "")) for i in range(20, 320)]
    docs = docs_table(spark, rows + hard_rows(), True)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in rows] + [(None, 1, 1), (1, None, None), (2, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + len(hard_rows()) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert all(by[i].predicted == (i % 3 == 0) for i, _ in rows)
    assert by[21 + 2].evidence is not None and by[2].similarity == 0
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == sum(r.predicted == 0 for r in out)
    none = toxicity.fit(docs, labels.filter("toxic = 1"), F.lit(True))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {1.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0), crc_mod(F.col("doc_id"), 5) != 0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
