import os
import random

import numpy as np
import pytest

from roomweave.llm import langid, leakage, tokenize, words

needs_vocabulary = pytest.mark.skipif(not os.path.exists(tokenize.VOCABULARY), reason="no vocabulary here")


@needs_vocabulary
def test_ids_are_those_of_the_public_encoder(spark, small):
    import tiktoken

    own = tokenize.encoder()
    public = tiktoken.Encoding("t", pat_str=tokenize.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["", " ", "\n\n \t", "aaaa" * 500, "<|endoftext|>", "👨‍👩‍👧 n​x é ǅ", "0123456789" * 40, "it's I'LL"] + ["".join(rng.choice(a) for _ in range(rng.randint(1, 80))) for a in ("ab", "the in ", "ÄöÜПривіт ", "=-_*#\n ", " '’s") for _ in range(60)]
    assert [own.encode(t) for t in texts] == [public.encode_ordinary(t) for t in texts]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r.ids for r in tokenize.encode(docs).collect()}
    assert got == {r.doc_id: public.encode_ordinary(r.text or "") for r in docs.collect()}


@needs_vocabulary
def test_null_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, [9]), (2, "", [9]), (2, "a b", [9])], "doc_id long, text string, ids array<int>")
    assert sorted((r.doc_id, len(r.ids)) for r in tokenize.encode(df).collect()) == [(1, 0), (2, 0), (2, 2)]
    assert tokenize.encode(df.limit(0)).count() == 0


def test_suffix_automaton():
    vocabulary = [b"ab", b"abc", b"bc", b"c", b"cab"]
    auto = tokenize.SuffixAutomaton(vocabulary)
    state = matched = 0
    for end, byte in enumerate(text := b"xabcab", 1):
        state, matched = auto.step(state, matched, byte)
        s = auto.ends[state if matched == auto.length[state] else auto.link[state]]
        found = set()
        while s > 0:
            found.add(vocabulary[auto.whole[s]])
            s = auto.ends[auto.link[s]]
        assert found == {v for v in vocabulary if text[:end].endswith(v)}


def brute(searcher, text):
    body = searcher.words(text or "").tolist()
    return {i for i, u in searcher.units.items() for k in range(max(1, len(body))) if leakage.in_order(u, body[k : k + len(u) + min(leakage.SLACK, len(u) // 3)]) >= leakage.IN_ORDER}


SENTENCES = ["The quick brown fox jumped over nine lazy dogs beside the silent river bank.", "Nobody expected that the harbour master would publish seven secret ledgers before dawn.", "A short formula is said at this point of every sitting.", "Under grey clouds the baker counted forty copper coins twice while his brother slept."]


def test_leaks_against_brute_force(spark):
    rng = random.Random(1)
    filler = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(filler) for _ in range(n)) + "."
    items = spark.createDataFrame([(1, " ".join(SENTENCES[:3])), (2, SENTENCES[3] + " " + SENTENCES[2]), (3, None), (4, ""), (1, " ".join(SENTENCES[:3]))], "item_id long, text string")
    docs = [
        (1, prose(40) + " " + SENTENCES[0].upper() + " " + prose(900)),
        (2, SENTENCES[1].replace("harbour master", "harbour — Shame! — master").replace("seven", "eight")),
        (3, SENTENCES[3].replace("copper", "cop-\nper").replace("coins", "coins (Applause.)\n")),
        (4, "The quick brown fox " + prose(30) + " beside the silent river bank."),
        (5, None), (6, ""), (7, "　"), (8, prose(2000) + " " + SENTENCES[3]),
    ] + [(100 + i, prose(20) + " " + SENTENCES[2]) for i in range(40)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.leaks(table, items).collect())
    assert got == [(1, 1), (2, 1), (3, 2), (8, 2)]
    block = leakage.Block([(r.item_id, r.text) for r in items.collect()])
    searcher = leakage.Searcher({u: block.units[u] for u, _ in block.owners})
    found = {}
    for place, unit, *_ in searcher.find([t for _, t in docs]):
        found.setdefault(place, set()).add(unit)
    assert all(found.get(i, set()) == brute(searcher, t) for i, (_, t) in enumerate(docs))


def test_blocks_of_items_and_empty_tables(spark):
    items = spark.createDataFrame([(i, s) for i, s in enumerate(SENTENCES)], "item_id long, text string")
    docs = spark.createDataFrame([(1, SENTENCES[0]), (2, SENTENCES[3])], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items, block_chars=60).collect()) == [(1, 0), (2, 3)]
    assert leakage.leaks(docs.limit(0), items).count() == 0 and leakage.leaks(docs, items.limit(0)).count() == 0


def test_a_leak_in_many_copies_is_no_formula(spark):
    docs = spark.createDataFrame([(i, SENTENCES[0]) for i in range(40)] + [(100 + i, f"other text number n{i} about nothing at all") for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(1, SENTENCES[0])], "item_id long, text string")
    assert leakage.leaks(docs, items).count() == 40


@pytest.mark.parametrize("n", [6, 8, 10, 12, 15, 20, 30, 40, 60, 80, 111, 112, 130, 200])
def test_recall_with_a_fifth_of_the_words_replaced(n):
    rng = random.Random(n)
    some = lambda k: [f"w{rng.randrange(5000)}" for _ in range(k)]
    units = [some(n) for _ in range(150)]
    texts = []
    for u in units:
        changed = list(u)
        for at in rng.sample(range(n), n // 5):
            changed[at] = f"x{at}"
        texts.append(" ".join(some(rng.randrange(200)) + changed + some(rng.randrange(200))))
    found = {(i, u) for i, u, *_ in leakage.Searcher({i: np.array([leakage._number(w) for w in u], np.uint64) for i, u in enumerate(units)}).find(texts)}
    assert sum((i, i) in found for i in range(150)) >= 0.9 * 150 and all(i == u for i, u in found)


def test_a_sentence_with_another_phrase_is_only_alike():
    unit = [f"w{i}" for i in range(25)]
    scattered = [x if i % 6 else "new" for i, x in enumerate(unit)]
    phrase = unit[:10] + ["some", "other", "phrase", "here"] + unit[14:]
    assert leakage.in_order(unit, unit) == 1.0 and leakage.in_order(unit, scattered) == 0.8 and leakage.in_order(unit, phrase) == 0.0
    assert leakage.in_order(unit, unit[:10] + ["a", "b", "c"] + unit[13:]) == 0.88 and leakage.in_order(unit, []) == 0.0


def test_last_half_counts_beside_formulas(spark):
    long = "one tall clerk carried the oldest map of the river delta over five narrow bridges while two younger clerks counted every lantern along the frozen bank"
    formula = "The house takes note of this answer and moves on."
    items = spark.createDataFrame([(1, f"{long}. {formula}"), (2, f"{long} again and again. No.")], "item_id long, text string")
    half = " ".join(long.split()[12:])
    docs = spark.createDataFrame([(1, f"Something else then {half}. And more words follow."), (2, "Nothing of that sort.")] + [(10 + i, f"Speech number n{i} is about k{i}. {formula}") for i in range(30)], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items, formula_share=0.2).collect()) == [(1, 1), (1, 2)]
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs.where("doc_id < 10"), items).collect()) == [(1, 2)]  # no formula here: the sentence is missed


def test_folding():
    assert words.words("ﬁne ÉTÉ Łódź​ straße") == ["fine", "ete", "lodz", "strasse"]
    assert words.without_interruptions("a (Hear!) b — Order! — c [x] d") .split() == ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def texts(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/lang_samples.parquet")


def test_language_on_held_out_samples(texts):
    rows = texts[1].collect()
    train = {}
    for r in rows:
        if r.sample_id % 5:
            train[r.lang] = train.get(r.lang, "") + "\n" + r.text
    own = langid.CrossParser(train)
    held = [r for r in rows if r.sample_id % 5 == 0]
    guessed = [own.languages[p[-1][0]] for p in own.parse([r.text for r in held])]
    assert sum(g == r.lang for g, r in zip(guessed, held, strict=True)) >= 0.98 * len(held)


def test_segments_of_a_mixed_text(spark, texts):
    de, fr = (texts[1].where(f"lang = '{x}'").first().text for x in ("de", "fr"))
    docs = spark.createDataFrame([(1, f"{de} {fr}", "de", "x"), (2, de, "DE-at", "x"), (3, de.upper(), None, "x"), (4, None, None, "x"), (5, " 　 42", "fr", "x"), (6, fr, "it", "x"), (7, fr + " (“de brandweer”)", "French", "x")], "doc_id long, text string, lang string, confidence string")
    got = sorted(map(tuple, langid.wrong_labels(docs, texts[1]).collect()))
    assert got == [(1, "de"), (1, "fr"), (3, "de"), (6, "fr")]
    runs = [(r.segment, r.lang) for r in langid.segments(docs.where("doc_id = 1"), texts[1]).orderBy("segment").collect()]
    assert runs == [(0, "de"), (1, "fr")]
    assert {r.doc_id: r.languages for r in langid.languages(docs, texts[1]).collect()} == {1: 2, 2: 1, 3: 1, 6: 1, 7: 1}
    assert langid.wrong_labels(docs.limit(0), texts[1]).count() == 0 and langid.wrong_labels(docs, texts[1].limit(0)).count() == 0


def test_labels():
    assert [langid.label_language(x) for x in ("en-GB", "ENG", "German ", "uk_UA", "pt-BR", "it", "und", "", None)] == ["en", "en", "de", "uk", "pt", None, None, None, None]


def greedy(text, lines, known):
    """Phrases by plain substring search: the longest match from each place on; letters of no sample count for none."""
    at = n = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and any(text[at : at + size + 1] in line for line in lines):
            size += 1
        n += text[at] in known
        at += size
    return n


def test_phrases_run_over_words():
    rng = random.Random(3)
    some = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(n))
    samples = {"a": "\n".join(some("abc", 12) for _ in range(5)), "b": "\n".join(some("bcde", 12) for _ in range(5))}
    own = langid.CrossParser(samples)
    lines = {lang: [f" {line} " for line in text.split("\n")] for lang, text in samples.items()}
    texts = [f" {some('abcdex', rng.randint(1, 30))} " for _ in range(50)] + [lines["a"][2]]
    assert own.phrases(texts).tolist() == [[greedy(t, lines["a"], set("abcde ")), greedy(t, lines["b"], set("abcde "))] for t in texts]
    assert own.phrases(texts)[-1][0] == 1  # a whole line is one phrase, not one a word


def test_long_sentences_are_parsed_in_pieces(monkeypatch):
    samples = {"en": "the quick brown fox jumps over the lazy dog", "de": "der schnelle braune fuchs springt hinweg"}
    own = langid.CrossParser(samples)
    text = f" {samples['en']} " * 200
    whole = own.phrases([text])[0]
    monkeypatch.setattr(langid, "LANE", 100)
    monkeypatch.setattr(langid, "LANES", 7)
    parts = -(-len(text) // 100)
    assert all(abs(a - b) <= parts for a, b in zip(own.phrases([text])[0], whole, strict=True))
    assert own.languages[own.parse([text])[0][-1][0]] == "en"


#: Sentences about what no sample is about; words that some sample holds are taken out before the test.
STRANGE = {
    "en": "Yesterday several laughing children were running through flooded gardens, shouting something wonderful about nightingales.",
    "de": "Gestern liefen lachende Kinder schreiend durch überschwemmte Gärten und erzählten wunderbare Geschichten über Nachtigallen.",
    "fr": "Quelques enfants couraient joyeusement parmi les jardins mouillés, racontant des merveilles sur leurs oiseaux préférés.",
    "es": "Algunos niños corrían alegremente entre jardines mojados, gritando maravillas sobre ruiseñores desconocidos.",
    "pt": "Algumas crianças corriam alegremente entre jardins molhados, gritando maravilhas sobre rouxinóis desconhecidos.",
    "nl": "Gisteren renden lachende kinderen schreeuwend door overstroomde tuinen en vertelden wonderlijke verhalen over nachtegalen.",
    "pl": "Wczoraj roześmiane dzieci biegały krzycząc przez zalane ogrody i opowiadały cudowne historie o słowikach.",
    "uk": "Вчора веселі діти бігали затопленими садками і розповідали чудові історії про солов'їв.",
}


def test_words_that_no_sample_holds(texts):
    train = {}
    for r in texts[1].collect():
        train[r.lang] = train.get(r.lang, "") + "\n" + r.text
    own = langid.CrossParser(train)
    known = {w for t in train.values() for w in words.words(t)}
    asked = {lang: " ".join(w for w in words.words(t) if w not in known) for lang, t in STRANGE.items()}
    assert all(len(t.split()) >= 6 for t in asked.values())
    right = lambda ts: sum(own.languages[p[-1][0]] == lang for lang, p in zip(ts, own.parse(list(ts.values())), strict=True))
    assert right(STRANGE) >= 6 and right(asked) >= 6  # samples of 15,000 characters on other subjects: two of eight are mistaken


def test_samples_beyond_the_bound_are_drawn_from_all_languages(spark):
    rows = [(i, "en" if i < 3000 else "German", f"text number {i} of its language\nand more") for i in range(6000)] + [(9000, "fr", "x" * 5000), (9001, None, "none"), (9002, "it", "other"), (9003, "fr", None)]
    table = spark.createDataFrame(rows, "sample_id long, lang string, text string")
    got = dict(langid.fitted(table, 4000))
    assert set(got) == {"de", "en", "fr"} and all(len(t) == 4000 for t in got.values())
    assert len(set(got["en"].split("\n"))) > 50 and got == dict(langid.fitted(table.repartition(7).orderBy("lang"), 4000))
    assert langid.fitted(table.where("lang = 'it'")) == ()
