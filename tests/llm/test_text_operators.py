"""Operators on texts against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

import base64
import hashlib
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm import bm25_packing, byte_bpe, crf_language, html_consensus, mcd_quality, minimax_shards
from orderloom.llm import ngram_jaccard, ppm_scoring
from orderloom.llm.common import components, ship_package

RNG = np.random.default_rng(3)
WORDS = ["the", "ouer", "thing", "ver", "été", "Haus", "edon", "shan", "of", "ring", "ble", "tion", "an,", "re."]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


def changed(text, n):
    words = text.split()
    for i in RNG.choice(len(words), n, replace=False):
        words[i] = f"w{RNG.integers(10**6)}"
    return " ".join(words)


BASE = prose(200)
TEXTS = [None, "", "  \n\t ", "one two", "one  TWO", "one two three four five", BASE, BASE.upper().replace("É", "é"), BASE,
         *(changed(BASE, n) for n in (1, 2, 3, 4, 5, 6, 9, 14)), prose(3000), *(prose(int(n)) for n in RNG.integers(1, 90, 25)),
         "a" * 5000, "  lead\n\n  and trail  ", "It's 12 o'clock ...\r\n\tTab  end ", "dup line\ndup line\n\nother\ndup line",
         " ".join(["repeat this very long line of words again"] * 12), "\x1cx\x85y z ﬁ ½ 語 \U0001f600"]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}", 7) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, BASE, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key long").repartition(3)


def given(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = lowered(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def test_jaccard_components(docs):
    rows = given(docs)
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                group[root(i)] = root(j)
    least = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        least[root(i)].append(name)
    expected = Counter((name, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None))
                       for i, (name, _) in enumerate(rows))
    got = ngram_jaccard.ngram_jaccard_components(docs)
    assert Counter(map(tuple, got.collect())) == expected
    assert ngram_jaccard.ngram_jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [8, 40, 300])
def test_jaccard_finds_each_lone_pair(spark, size):
    rows = []
    for k in range(20):  # pairs that share signatures with nobody else
        text = [f"w{k}x{i}" for i in range(size)]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join([*text, "end"] if k % 2 else text[1:] + text[:1]))]
    expected = {n: n - n % 2 if linked(*(shingles(rows[i][1]) for i in (n - n % 2, n | 1))) else n for n, _ in rows}
    got = ngram_jaccard.ngram_jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == expected
    assert any(of != n for n, of in expected.items()) or size == 8


@pytest.mark.parametrize("size", [4, 5, 9, 33, 150])
def test_signatures_lose_no_linked_pair(size):
    windows = ngram_jaccard.Windows(80)
    for _ in range(150):
        whole = np.unique(RNG.integers(0, 2**64, size, dtype=np.uint64))
        other = RNG.integers(0, 2**64, size, dtype=np.uint64)
        drop, add = RNG.integers(0, size // 5 + 1, 2)
        second = np.unique(np.concatenate([whole[int(drop):], other[:int(add)]]))
        if linked(set(whole.tolist()), set(second.tolist())):
            a, b = (ngram_jaccard.signatures(x, windows) for x in (whole, second))
            assert ngram_jaccard.set_key(whole) == ngram_jaccard.set_key(second) or set(a.tolist()) & set(b.tolist())
            x, y = (np.frombuffer(ngram_jaccard.sketch(s), dtype=np.uint8) for s in (whole, second))
            assert ngram_jaccard.sketches_differ(x, y) <= len(set(whole.tolist()) ^ set(second.tolist()))


def test_a_common_passage_makes_no_candidates(spark, monkeypatch):
    passage, rows = " ".join(f"common{i}" for i in range(40)), []
    for k in range(40):  # each with the passage: lone texts, and pairs that link or just do not
        text = [f"w{k}x{i}" for i in range(120)]
        rows.append((2 * k, " ".join(text) + " " + passage))
        if k % 4 == 0:
            rows.append((2 * k + 1, " ".join([*text[:120 - k], *(f"v{k}x{i}" for i in range(k // 3))]) + " " + passage))
    sets = {n: shingles(t) for n, t in rows}
    expected = {n: n - 1 if n % 2 and linked(sets[n], sets[n - 1]) else n for n, _ in rows}
    assert 2 < sum(of != n for n, of in expected.items()) < 8
    asked, settle = [], ngram_jaccard.settle

    def watched(frame, purpose):
        out = settle(frame, purpose)
        if purpose == "runs":
            asked.extend(r["key"] for r in out.select("key").distinct().collect())
        return out

    monkeypatch.setattr(ngram_jaccard, "settle", watched)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_jaccard.ngram_jaccard_components(docs).collect()} == expected
    pairs = pa.array([t for n, t in rows if (n & ~1) | 1 in sets])
    assert set(asked) <= {ngram_jaccard.set_key(x) for x in ngram_jaccard.shingle_sets(pairs, 5)}


@pytest.mark.parametrize("size", [4, 5, 9, 33, 150, 600])
def test_linked_sets_share_as_many_signatures_as_stated(size):
    windows = ngram_jaccard.Windows(80)
    for _ in range(100):
        whole = np.unique(RNG.integers(0, 2**64, size, dtype=np.uint64))
        second = np.unique(np.concatenate([whole[size // 9:], RNG.integers(0, 2**64, size // 9, dtype=np.uint64)]))
        if linked(set(whole.tolist()), set(second.tolist())):
            shared = np.intersect1d(*(ngram_jaccard.signatures(x, windows) for x in (whole, second)))
            least = [dict(ngram_jaccard.shared_at_least(x, windows)) for x in (whole, second)]
            both = least[0].keys() & least[1].keys()
            assert not windows.difference(len(whole) + len(second)) or any(
                np.count_nonzero(shared & np.uint64(255) == w) >= max(x[w] for x in least) for w in both)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 102)], "a long, b long")
    got = {(r["node"], r["component"]) for r in components(links).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}


PAGE = ("<html><head><title>T &amp; t</title><style>p{}</style><script>var a='</p>';</script></head><body class=x>"
        "<nav><ul><li><a href='/'>Home</a></ul></nav><div class='ad'>Buy</div><div class='story-12'><h1>Head&nbsp;line</h1>"
        "<p>First  &lt;b&gt; <b>bold\n text</b>, with words enough to count.<br>More.<p>Second &eacute;&#233; &am paragraph"
        "<form><input value='x>y'>No</form><!-- <p>no</p> --><p>Third one here.</div>"
        "<div class='comments'><p>A reader says a great many words, more than the article itself has got, on and on and on, "
        "and does not stop before the page ends.</p></div><footer>&copy; x</footer>")


def test_html(spark):
    ship_package(spark)
    text = "Head line\nFirst <b> bold text , with words enough to count. More.\nSecond éé &am paragraph\nThird one here."
    text = text.replace("text ,", "text,")
    rows = [(1, "http://U@A.example:80/x", PAGE), (2, "http://a.example/y", PAGE.replace("story-12", "story-7")),
            (3, None, None), (4, "x", ""), (5, "", "plain &amp; <nothing"), (1, "http://U@A.example:80/x", PAGE)]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    got = {(r["page_id"], r["text"], r["n_chars"]) for r in html_consensus.extract_pages(pages).collect()}
    assert got == {(1, text, len(text)), (2, text, len(text)), (3, "", 0), (4, "", 0), (5, "plain &", 7)}
    assert html_consensus.extract_pages(pages.limit(0)).count() == 0


def test_a_host_outvotes_a_page_misled_by_a_notice(spark):
    ship_package(spark)
    body = "<body><div class=main><p>Article text {n} of this page.</p></div><div class=box><p>{notice}</p></div></body>"
    pages = spark.createDataFrame([(n, "http://h/", body.format(n=n, notice="Long notice. " * 40 if n == 9 else "Short."))
                                   for n in range(10)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_consensus.extract_pages(pages).collect()}
    assert got == {n: f"Article text {n} of this page." for n in range(10)}


LONG = "Many words that tell what happened there, and then some more of them. " * 6
SECTIONED = [
    ("<article><h1>Title</h1><p>The lead.</p><section><p>{0}</p></section><section><p>{0}</p></section>Last words.</article>",
     ["Title", "The lead.", LONG, LONG, "Last words."]),
    ("<main><h1>Title</h1><article><p>Short.</p><blockquote><p>{0}</p></blockquote><p>Said so.</p></article></main>",
     ["Title", "Short.", LONG, "Said so."]),
    ("<div class=story><p>Before.</p><table><tr><td>{0}</td><td>{0}</td></tr></table><p>After.</p></div>",
     ["Before.", LONG, LONG, "After."]),
    ("<div class=story><p>Before.</p><dl><dt>Term</dt><dd>{0}</dd></dl></div>", ["Before.", "Term", LONG]),
    ("<div class=story><h1>Title</h1><section><p>{0}</p></section><section class=b><p>{0}</p></section></div>",
     ["Title", LONG, LONG])]


@pytest.mark.parametrize("inside, blocks", SECTIONED)
def test_sections_quotes_and_cells_do_not_stand_for_the_article(spark, inside, blocks):
    ship_package(spark)
    page = ("<body><nav><a href=/>Home</a></nav><div class=links><a href=/a>One link here</a></div>" + inside.format(LONG)
            + "<div class=box><p>Read our terms.</p></div><footer>End</footer></body>")
    pages = spark.createDataFrame([(n, "http://h/", page) for n in range(3)], "page_id long, url string, html string")
    got = {r["text"] for r in html_consensus.extract_pages(pages).collect()}
    assert got == {"\n".join(b.strip() for b in blocks)}


def test_a_teaser_at_the_hosts_path_is_not_the_article():
    post = html_consensus.best_path(html_consensus.read_blocks(f"<body><div class=post><p>{LONG}</p></div></body>"))
    page = f"<body><div class=post><p>Short teaser.</p></div><div class=entry><p>{LONG}</p></div></body>"
    assert html_consensus.main_text(page, [post]) == LONG.strip()
    assert html_consensus.main_text(page.replace("Short teaser.", LONG + "Own."), [post]) == LONG + "Own."


@pytest.mark.parametrize("inside, text", [
    ("<p>Let <math>x=2</math> be given.</p>", "Let x=2 be given."),
    ("<p>Before</p><object><p>Fallback.</p></object>", "Before\nFallback."),
    ('<p class="social-science">Studied.</p><div id="search-results-explained"><p>Explained.</p></div>', "Studied.\nExplained."),
    ('<p>Kept.</p><div class="social-links"><p>Share it</p></div><div id="cookie-banner">We use</div>', "Kept."),
    ("<header><h1>Title</h1></header><p>Text.</p>", "Title\nText."),
    ('<p>Kept.</p><form><select><option>One</option></select></form><svg><title>x</title></svg>', "Kept.")])
def test_what_an_article_keeps(inside, text):
    page = f"<body><header>Site</header><article>{inside}<p>{LONG}</p></article><footer>End</footer></body>"
    assert html_consensus.main_text(page, []) == text + "\n" + LONG.strip()


def test_deep_nesting_takes_linear_time():
    began = time.process_time()
    for tag in ("div", "section"):
        page = "".join(f"<{tag}>w{k} " for k in range(10000))
        assert len(html_consensus.main_text(page, ["x"]).split("\n")) == 10000
    assert time.process_time() - began < 10


def test_votes_against_counting(spark):
    """The host's path, by counting every page's best path."""
    ship_package(spark)
    pages = []
    for n in range(60):
        kind = ("story", "entry", f"only-{'abcdefgh'[n % 8]}{'xyz'[n % 3]}")[0 if n % 5 else 1 + n % 2]
        other = "entry" if kind == "story" else "story"
        pages.append((n, f"http://h{n % 3}/", f"<body><div class={kind}><p>Own {n}. {'Filled up. ' * (n % 7 + 3)}</p></div>"
                      f"<div class={other}><p>Other {n}. {'Filled up. ' * (n % 4)}</p></div></body>"))
    votes = defaultdict(Counter)
    for _, url, page in pages:
        votes[url][html_consensus.best_path(html_consensus.read_blocks(page))] += 1
    expected = {}
    for n, url, page in pages:
        order = sorted((p for p, k in votes[url].items() if k >= 2), key=lambda p: (-votes[url][p], p))
        expected[n] = html_consensus.main_text(page, order)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    assert {r["page_id"]: r["text"] for r in html_consensus.extract_pages(frame).collect()} == expected


def least_capacity(sizes, shards):
    capacity = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards:
            return capacity
        capacity += 1


def test_shards(docs, spark):
    small = docs.where("text is null or length(text) < 2000")
    rows = small.collect()
    got = minimax_shards.shard_documents(small, 4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and {r["law"] for r in got} == {"bytes"}
    by_text = defaultdict(set)
    texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    for r in got:
        if r["doc_id"] is not None:
            by_text[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    groups = defaultdict(lambda: [10**9, 0])
    for r in rows:
        groups[r["text"]][0] = min(groups[r["text"]][0], 10**9 if r["doc_id"] is None else r["doc_id"])
        groups[r["text"]][1] += len((r["text"] or "").encode()) + 1
    sizes, total = [], sum(s for _, s in groups.values())
    heavy = [s for _, s in groups.values() if s * 4 >= total]
    if not heavy:
        sizes = [s for _, s in sorted(groups.values())]
        shard = Counter()
        for r in got:
            shard[r["shard"]] += r["size"]
        assert max(shard.values()) == least_capacity(sizes, 4)
    assert minimax_shards.shard_documents(small.limit(0)).count() == 0


def test_a_group_larger_than_a_share_gets_its_own_shard(spark):
    rows = [(i, "x" * 99) for i in range(50)] + [(100 + i, f"{i:09d}") for i in range(60)]
    got = minimax_shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    assert sorted(size.values()) == [200, 200, 200, 5000]


def test_packing(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for name, text in given(docs):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected[name, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = bm25_packing.pack_documents(docs, path).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or at & (at - 1) == 0
    assert sum(r["length"] for r in got) == sum(n * k for (_, n, _), k in expected.items())
    whole = Counter((r["doc_id"], r["doc_tokens"], r["ids_crc32"]) for r in got if r["length"] == r["doc_tokens"])
    assert not whole - expected
    for name in {r["doc_id"] for r in got if r["length"] < r["doc_tokens"]} - {None, 6}:
        own = sorted((r["start"], r["length"], r["doc_tokens"]) for r in got if r["doc_id"] == name)
        assert [s for s, _, _ in own] == list(np.cumsum([0] + [n for _, n, _ in own[:-1]])) and own[-1][0] + own[-1][1] == own[0][2]
    assert bm25_packing.pack_documents(docs.limit(0), path).count() == 0


def test_packing_prefers_the_nearest_neighbour():
    near = np.array([5, 6, 7, 8, 9, 10], dtype=np.uint32)
    far = [np.array([20 + k, 40 + k, 60 + k, 80 + k], dtype=np.uint32) for k in range(12)]
    documents = [near, *far, near + 0, far[0] + 0]
    first = bm25_packing.pack(documents, 12)[0]
    assert [d for d, _, _ in first[:2]] == [0, 13]


def test_crf(docs):
    def chain(model, emissions):
        step = np.exp(model.transitions - model.transitions.max())
        score, n = np.exp(emissions), len(model.labels)
        alpha, beta = [np.full(n, 1.0)], [np.ones(n)]
        for e in score:
            alpha.append((alpha[-1] @ step) * e / e.sum())
            alpha[-1] /= alpha[-1].sum()
        for e in score[::-1]:
            beta.insert(0, step @ (e * beta[0]))
            beta[0] /= beta[0].sum()
        out = np.array([a * b for a, b in zip(alpha[1:], beta[1:])])
        return out / out.sum(axis=1, keepdims=True)

    model = crf_language.Model(["a", "b", "c"], crf_language.Lexicon([]))
    model.transitions = RNG.normal(size=(3, 3))
    sizes = [0, 1, 5, 64, 65, 200, 0, 300]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    emissions = RNG.normal(size=(bounds[-1], 3)) * 2
    got = model.posteriors(emissions, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            assert np.allclose(got[a:b], chain(model, emissions[a:b]), atol=1e-9)


def test_languages(spark):
    ship_package(spark)
    parts = {"en": ["the", "tion", "ing", "shan", "wher", "ond"], "de": ["sch", "über", "keit", "zu", "ein", "pf"],
             "fr": ["eau", "éle", "oi", "ment", "que", "aux"]}

    def text(lang, n):
        return " ".join("".join(RNG.choice(parts[lang], RNG.integers(1, 4))) for _ in range(n))

    labelled = [(text(lang, 40), lang) for lang in parts for _ in range(60)]
    training = spark.createDataFrame([*labelled, (None, "en"), ("x", None)], "text string, lang string")
    mixed = text("en", 15) + " " + text("fr", 15)
    asked = [(1, text("de", 30), "de"), (2, text("fr", 30), "fr"), (3, None, "und"), (4, "", "und"), (5, "123 -- !", "und"),
             (6, mixed, None), (None, text("en", 12), "en"), (1, text("de", 3000), "de")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in asked], "doc_id long, text string")
    got = crf_language.label_documents(docs, training).collect()
    assert Counter((r["doc_id"], r["lang_pred"]) for r in got if r["doc_id"] != 6) == Counter((i, x) for i, _, x in asked if i != 6)
    assert all(0 <= r["score"] <= 1 for r in got) and {r["score"] for r in got if r["lang_pred"] == "und"} == {0.0}
    runs = next(r["runs"] for r in got if r["doc_id"] == 6)
    assert [r["lang"] for r in runs] == ["en", "fr"] and abs(runs[0]["words"] - 15) <= 1
    assert {r["lang_pred"] for r in crf_language.label_documents(docs, training.limit(0)).collect()} == {"und"}
    assert crf_language.label_documents(docs.limit(0), training).count() == 0


def test_languages_of_kept_texts_take_little_memory(spark, monkeypatch):
    ship_package(spark)
    training = spark.createDataFrame([("the thing of the ring", "en"), ("das Haus und ein Ring", "de")] * 20, "text string, lang string")
    rows = [(1, "the thing"), (2, None), (3, "ein Haus"), (3, "ein Haus")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lone, kept = (crf_language.label_documents(docs, training, keep) for keep in (("doc_id",), ("doc_id", "text")))
    assert sorted(map(str, kept.drop("text").collect())) == sorted(map(str, lone.collect()))
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(rows)
    taken = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, work, schema: taken.append((rows, work)) or rows)
    crf_language.label_documents(docs, training, ("doc_id", "text"))
    sent, work = taken[0]
    assert sent.columns == ["doc_id", "text"]  # the text once
    text = pa.array([prose(400)] * 2000)
    tracemalloc.start()
    done = sum(out.num_rows for out in work([pa.RecordBatch.from_arrays([pa.array(range(2000)), text], names=sent.columns)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done == 2000 and peak < 100e6


def test_many_languages_with_long_texts_only(spark):
    """Fifteen languages share their letters, so words tell them apart; no text of theirs is short."""
    ship_package(spark)
    rng = np.random.default_rng(4)
    names = [f"l{k:02d}" for k in range(15)]
    words = {x: ["".join(rng.choice(list("abcdeé"), 4)) for _ in range(60)] for x in names}

    def text(lang, n):
        return " ".join(rng.choice(words[lang], n))

    labelled = [(text(lang, 1500), lang) for lang in names for _ in range(8)]
    assert min(len(t) for t, _ in labelled) > crf_language.SAMPLE_CHARS
    training = spark.createDataFrame(labelled, "text string, lang string")
    sample = crf_language.training_sample(training).collect()
    assert all(6 <= n <= 8 for n in Counter(r["lang"] for r in sample).values())  # one for each value of a hash
    assert {len(r["text"]) for r in sample} == {crf_language.SAMPLE_CHARS}
    model = crf_language.fit([r["text"] for r in sample], [r["lang"] for r in sample])
    assert len(model.lexicon.keys) > 600
    assert all(model.entries[k, k] > 0.2 for k in range(15))  # a language's lexicon speaks for it
    docs = spark.createDataFrame([(k, text(x, 30)) for k, x in enumerate(names)], "doc_id long, text string")
    got = crf_language.label_documents(docs, training).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == dict(enumerate(names))


def test_lexicon_pairs():
    lists = [RNG.choice(40, 15, replace=False).astype(np.uint64) for _ in range(14)] + [np.zeros(0, dtype=np.uint64)]
    words = RNG.integers(0, 50, 200).astype(np.uint64)
    got = list(zip(*(x.tolist() for x in crf_language.Lexicon(lists).pairs(words))))
    assert got == [(i, k) for i, w in enumerate(words) for k, x in enumerate(lists) if w in x]


def test_expected_moves():
    """Against all label sequences of a short chain; the label in front of the first word is any one."""
    rng = np.random.default_rng(2)
    model = crf_language.Model(["a", "b"], crf_language.Lexicon([]))
    model.transitions = rng.normal(size=(2, 2))
    emissions = rng.normal(size=(crf_language.CHAIN, 2))
    paths = ((np.arange(1 << crf_language.CHAIN - 10)[:, None] >> np.arange(crf_language.CHAIN - 10)) & 1)
    emissions[crf_language.CHAIN - 10:, 1] = -60.0  # the last ten words are of the first label for certain
    paths = np.concatenate([paths, np.zeros((len(paths), 10), dtype=int)], axis=1)
    weight = emissions[np.arange(crf_language.CHAIN), paths].sum(axis=1)
    weight += model.transitions[paths[:, :-1], paths[:, 1:]].sum(axis=1) + np.log(np.exp(model.transitions).sum(axis=0))[paths[:, 0]]
    chance = np.exp(weight - weight.max())
    chance /= chance.sum()
    exact = np.zeros((2, 2))
    np.add.at(exact, (paths[:, :-1], paths[:, 1:]), np.repeat(chance[:, None], crf_language.CHAIN - 1, axis=1))
    assert np.allclose(crf_language._expected_moves(model, emissions, 2), exact, atol=1e-6)


def test_ppm(docs):
    rows = given(docs)
    order = ppm_scoring.ORDER
    learned = [t or "" for i, t in rows if zlib.crc32((str(i) if i is not None else "").encode()) % 5 != 1]
    words, counts = Counter(), [defaultdict(Counter) for _ in range(order + 1)]
    for t in learned:
        words.update([*lowered(t), None])
        data = bytes(order) + t.encode()
        for p, s in enumerate([*data[order:], 256]):
            for k in range(order + 1):
                counts[k][data[p + order - k:p + order]][s] += 1
    total, distinct = sum(words.values()), len(words)

    def ppm(t):
        data, out = bytes(order) + t.encode(), 0.0
        for p, s in enumerate([*data[order:], 256]):
            gone = set()
            for k in range(order, -1, -1):
                seen = counts[k].get(data[p + order - k:p + order])
                if seen is None:
                    continue
                left = {x: n for x, n in seen.items() if x not in gone}
                if s in left:
                    out += math.log10((2 * left[s] - 1) / (2 * sum(left.values())))
                    break
                if left:
                    out += math.log10(len(left) / (2 * sum(left.values())))
                gone |= set(left)
            else:
                out -= math.log10(257 - len(gone))
        return out

    expected = defaultdict(list)
    for i, t in rows:
        w = [*lowered(t), None]
        base = sum(math.log10((words[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w)
        expected[i].append((len(w), sum(words[x] > 0 for x in w), total, base, ppm(t or "")))
    got = ppm_scoring.score_documents(docs, crf_language.remainder() != 1).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(r["n_tokens"] == e[0] and r["n_known"] == e[1] and r["train_tokens"] == e[2]
                   and r["base_score"] == pytest.approx(e[3], rel=1e-9) and r["score"] == pytest.approx(e[4], rel=1e-9)
                   for e in expected[r["doc_id"]]), (r, expected[r["doc_id"]])
    assert ppm_scoring.score_documents(docs, F.lit(False)).count() == len(rows)


def test_ppm_scores_do_not_depend_on_what_the_workers_hold(docs):
    training = crf_language.remainder() != 1
    expected = Counter((r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in ppm_scoring.score_documents(docs, training).collect())
    for nodes in (0, 300):
        got = ppm_scoring.score_documents(docs, training, nodes=nodes).collect()
        assert Counter((r["doc_id"], r["n_tokens"], round(r["score"], 6)) for r in got) == expected


def test_quality_statistics_and_verdicts(docs, spark):
    rows = {r["doc_id"]: r for r in mcd_quality.quality_rules(docs).collect()}
    for i, t in given(docs):
        w = words_of(t)
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        often = Counter(grams)
        covered = {x for k, g in enumerate(grams) if often[g] > 1 for x in range(k, k + 8)}
        seen, repeated = set(), 0
        for line in (t or "").split("\n"):
            if words_of(line):
                repeated += line in seen
                seen.add(line)
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), repeated, len(covered))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r["base_failed"] and r["kept"])
    odd = [(1000 + k, " ".join(f"{w}###$$$" for w in prose(60).split()), "en", "s") for k in range(8)]
    fine = [(k, prose(int(RNG.integers(25, 400))), "en", "s") for k in range(80)]
    judged = mcd_quality.quality_rules(spark.createDataFrame(odd + fine, "doc_id long, text string, lang string, source string"))
    verdicts = {r["doc_id"]: r["kept"] or r["base_failed"] for r in judged.collect()}
    assert not any(verdicts[i] for i, *_ in odd) and all(verdicts[i] for i, *_ in fine)
    assert mcd_quality.quality_rules(docs.limit(0)).count() == 0


def test_quality_sees_symbols_and_repeated_lines_in_short_texts(spark):
    rng = np.random.default_rng(11)

    def lines(n):
        return "\n".join(" ".join(rng.choice(WORDS[:12], 6)) + f" n{k} v{rng.integers(10**9)}" for k in range(n))

    fine = [(k, lines(int(rng.integers(4, 60)))) for k in range(80)]
    odd = [(1000 + k, " ".join(f"{w}{'#' * (j % 2)}" for j, w in enumerate(lines(16).split()))) for k in range(4)]
    odd += [(2000 + k, lines(8).replace("\n", "\nread on here\n") + "\nread on here") for k in range(4)]
    frame = spark.createDataFrame([(*r, "en", "s") for r in fine + odd], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["kept"], r["base_failed"]) for r in mcd_quality.quality_rules(frame).collect()}
    assert all(got[i] == (True, False) for i, _ in fine)
    assert all(got[i] == (False, False) for i, _ in odd)


def test_byte_bpe(docs):
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter((i, np.array(reference.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in given(docs))
    got = byte_bpe.encode_documents(docs, path).collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == expected
    assert byte_bpe.encode_documents(docs.limit(0), path).count() == 0
    table = byte_bpe.PerfectHash(list(ranks))
    assert {table.slot(t) for t in ranks} == set(range(len(ranks)))


def test_byte_bpe_white_space():
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    ranks = byte_bpe.read_ranks(path)
    own = byte_bpe.Encoder(byte_bpe.Tables(ranks, public_tokenizers.PATTERN))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for _ in range(400):
        text = "".join(RNG.choice([" ", "  ", "\n", "\t", "a", "'s", "7", ".", "é", " ", "word", "\x1c"], RNG.integers(0, 14)))
        ids = np.frombuffer(own.encode(text), dtype="<u4").tolist() if text else []
        assert ids == reference.encode_ordinary(text), repr(text)
    assert hashlib.sha256(own.decode(own.encode("a b"))).digest() == hashlib.sha256(b"a b").digest()


def test_word_hashes_follow_the_words():
    from orderloom.llm.common import text_bytes, word_hashes
    texts = [t for t in TEXTS]
    hashes, bounds = word_hashes(*text_bytes(pa.array(texts, pa.string())))
    known = {}
    for k, t in enumerate(texts):
        own = hashes[bounds[k]:bounds[k + 1]].tolist()
        assert len(own) == len(lowered(t))
        for w, h in zip(lowered(t), own):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_long_regular_words_have_hashes_of_their_own():
    from orderloom.llm.common import text_bytes, word_hashes
    marks = "".join("ab"[i.bit_count() & 1] for i in range(4096))
    hashes, _ = word_hashes(*text_bytes(pa.array([marks, marks.translate(str.maketrans("ab", "ba")), marks.upper()])))
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_word_tokenizer_agrees_with_the_library_on_hard_words():
    with open(public_tokenizers.path(bm25_packing.VOCABULARY), encoding="utf-8") as file:
        body = file.read()
    own, model = bm25_packing.WordTokenizer(body), Tokenizer.from_str(body)
    model.encode_special_tokens = True
    texts = ["", "ẞ İstanbul J̌ H̱x יִ abc", "Ⅰ a²b ½ x", "éa ÉA", "don't DON'T 'S x's' That That,", "日本 語。 中文",
             "##% .. a1b2c3,", "ΑΣ ΣΑΣ,", "a\x00b \x1c c\x1fd", "K K k", "ﬁne ǅ", "<|startoftext|>hi <|endoftext|>"]
    texts += [" ".join(f"{a}{b}" for a in "abcDEF" for b in ("xyz", "Qr", "é", "s,", "7")), "w" * 5000, "KADİ, क़. ড়! ਸ਼? གྷ;"]
    texts += ["".join(RNG.choice(list("aZé7İ'.,!$ <|>\u0301\u0307\u2019\u00a0\U0001f600"), 40)) for _ in range(300)]
    for text in texts * 2:  # new words, then remembered ones
        assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    everything = [f"Kad{chr(c)},. x{chr(c)}" for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000]
    ids, bounds = own.texts_ids(pa.array(everything))
    for i, found in enumerate(model.encode_batch(everything, add_special_tokens=False)):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == [*found.ids, bm25_packing.END], everything[i]


def test_word_tokenizer_in_stretches(monkeypatch):
    with open(public_tokenizers.path(bm25_packing.VOCABULARY), encoding="utf-8") as file:
        body = file.read()
    monkeypatch.setattr(bm25_packing, "SLICE_BYTES", 64)
    monkeypatch.setattr(bm25_packing, "REMEMBERED", 50)
    own, model = bm25_packing.WordTokenizer(body), Tokenizer.from_str(body)
    model.encode_special_tokens = True
    texts = [t or "" for t in TEXTS] + ["x" * 300, " " * 200, "y" * 63 + " z", "é" * 100 + "\n" + "b" * 64, ""]
    ids, bounds = own.texts_ids(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == [*model.encode(text, add_special_tokens=False).ids, bm25_packing.END]
