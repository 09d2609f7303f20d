"""Repeated sentence spans against a direct count."""

import random
from collections import defaultdict

from custos.llm import substring_dedup as sd
from tests.conftest import SF_SMALL
from tests.llm import cases


def brute(texts):
    first = defaultdict(list)
    for i, t in texts:
        for h, p, q in sd.runs(t or ""):
            first[h].append((i, p, q))
    gone = defaultdict(set)
    for places in first.values():
        for i, p, q in places:
            if (i, p) != min(places)[:2]:
                gone[i] |= set(range(p, q))
    return {i: sorted(gone[i]) for i, _ in texts}


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sd.dedup(df).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == brute(texts)
    whole = dict(texts)
    assert all(r["text"] == whole[r["doc_id"]] for r in got if not r["removed"])


def test_shared_passage_goes_from_the_second(spark):
    got = {r["doc_id"]: r for r in sd.dedup(cases.docs(spark).where("doc_id is not null")).collect()}
    assert got[10]["text"] == cases.TEXTS[10] and not got[10]["removed"]
    assert "villages" not in got[11]["text"] and got[11]["text"].startswith("Another opening") and got[11]["text"].endswith("Some closing remark is given too.")
    assert got[8]["text"] == cases.LONG and len(got[9]["text"]) < 200
    assert got[0]["text"] == got[1]["text"] == "" and got[3]["text"] == got[4]["text"] == "one"


def test_edges(spark):
    assert sd.dedup(cases.docs(spark)).count() == len(cases.rows())
    assert sd.dedup(cases.docs(spark, [])).count() == 0
    words = " ".join(f"w{i}" for i in range(70))
    got = sd.dedup(cases.plain(spark, ["Before it. " + words, words + ". After it."])).collect()
    assert sum(len(r["removed"]) for r in got) >= 2
    assert sum(n for *_, n in sd.sentences(words)) == 70


def test_unpunctuated_passage_at_every_offset(spark):
    rng = random.Random(3)
    passage = [f"p{rng.randrange(500)}" for _ in range(60)]
    for sep, texts in ((" ", 20), (" | ", 20)):
        docs = []
        for lead in range(texts):
            own = [f"d{lead}x{k}" for k in range(lead + 30)]
            docs.append(sep.join([*own[:lead], *passage, *own[lead:]]))
        got = {r["doc_id"]: r["text"].split() for r in sd.dedup(cases.plain(spark, docs)).collect()}
        assert got[0] == docs[0].split()
        for i in range(1, texts):
            kept = set(got[i])
            assert sum(w not in kept for w in passage) >= 20  # counted on the words, without sentences() and runs()
            assert all(w in kept for w in docs[i].split() if w.startswith("d"))


def test_cuts_of_equal_words_and_long_first_sentence(spark):
    assert sd.cuts(["a"] * 30) == list(range(31))[:1] + list(range(sd.WINDOW, 31))
    first = " ".join(f"w{i}" for i in range(70)) + ". And a short end of it."
    got = {r["doc_id"]: r["text"] for r in sd.dedup(cases.plain(spark, ["One two three " + first, "Other seven words which stand before it " + first])).collect()}
    assert got[0].endswith(first) and "short end" not in got[1] and "w35" not in got[1].split() and got[1].startswith("Other seven words")


def test_texts_without_an_id_or_under_one_id_are_told_apart(spark):
    clean = "A clean text begins here. " + " ".join(f"It has sentence {i} of its own, which no other has." for i in range(12))
    repeat = ["The lead. " + cases.SHARED + " The end of one.", "Another lead stands here. " + cases.SHARED + " The end of two."]
    for key in (None, 7):
        rows = [(key, clean), *((key, t) for t in repeat), (1, "First of all. " + cases.SHARED)]
        got = [(r["doc_id"], r["text"]) for r in sd.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert (key, clean) in got and rows[-1] in got
        assert sum("villages" in t for _, t in got) == 1
    rows = [(None, t) for t in repeat]
    got = [r["text"] for r in sd.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum("villages" in t for t in got) == 1


def test_last_sentences_of_a_passage_go_too(spark):
    say = lambda mark, n: " ".join(f"{mark}{i}" for i in range(n)) + "."
    passage = " ".join([say("a", 19), say("b", 2), say("c", 15)])
    docs = [f"{say(f'lead{k}x', 6)} {passage} {say(f'tail{k}x', 18)}" for k in range(3)]
    got = {r["doc_id"]: r for r in sd.dedup(cases.plain(spark, docs)).collect()}
    assert got[0]["text"] == docs[0]
    for k in (1, 2):
        assert got[k]["removed"] == [1, 2, 3] and got[k]["text"] == f"{say(f'lead{k}x', 6)} {say(f'tail{k}x', 18)}"


def test_runs_of_many_texts_at_once_are_those_of_each():
    rng = random.Random(8)
    texts = [t or "" for t in cases.TEXTS] + ["a\x1cb.\x85c d \n e! f", "É b. " * 30, " \n. . . ! a ?   b" + " w" * 50 + "\n", "x y\nz"]
    texts += ["".join(rng.choice(["w1 ", "W2 ", "longer ", "end. ", "q! ", "\n", "é\xa0", "　t "]) for _ in range(rng.randrange(200))) for _ in range(60)]
    text, place, stop, first, second = sd.run_table(texts)
    got = {(i, p, q): (a, b) for i, p, q, a, b in zip(*(x.tolist() for x in (text, place, stop, first, second)))}
    want = {(i, p, q): h for i, t in enumerate(texts) for h, p, q in sd.runs(t)}
    assert got.keys() == want.keys() and len(got) == len(text)
    assert len(set(want.values())) == len(set(got.values())) == len({(got[k], want[k]) for k in want})


def words_removed(texts, size):
    """Words that stand in a run of ``size`` equal words which an earlier place has too; no sentences, no hashes."""
    seen, gone = set(), [set() for _ in texts]
    for i, t in enumerate(texts):
        w = t.lower().split()
        for a in range(len(w) - size + 1):
            run = tuple(w[a:a + size])
            if run in seen:
                gone[i] |= set(range(a, a + size))
            seen.add(run)
    return gone


def test_removed_words_against_runs_of_words(spark):
    """Every word taken is a repeat of at least 20 words; of a repeated passage of sentences all words go."""
    rng = random.Random(5)
    sentence = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n)) + "."
    passages = [" ".join(sentence(rng.randrange(6, 15)) for _ in range(8)) for _ in range(5)]
    texts = [" ".join([sentence(9), *rng.sample(passages, 2), sentence(12), sentence(30)]) for _ in range(25)]
    repeated, rows = words_removed(texts, 20), {r["doc_id"]: r for r in sd.dedup(cases.plain(spark, texts)).collect()}
    seen = set()
    for i, t in enumerate(texts):
        left, all_words = rows[i]["text"].split(), t.split()
        gone = len(all_words) - len(left)
        assert gone <= len(repeated[i])
        old = sum(len(p.split()) for p in passages if p in t and p in seen)
        assert gone >= old
        seen |= {p for p in passages if p in t}
