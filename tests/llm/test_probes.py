"""Pages, words and batches that once gave wrong results."""

import numpy as np
import pytest

from capstan.llm import decontamination, language_id, simhash, substring_dedup
from capstan.llm.components import components
from capstan.llm.html_text import Blocks, blocks, high_blocks, main_text

ART = ("Long sentence of the article that goes on. " * 6).strip()
P = f"<p>{ART}</p>"


@pytest.mark.parametrize("page,text", [
    ("<p>see <b>this</b> word</p>", "see this word"),
    ("Foo <a>bar</a>, a <i>baz</i>", "Foo bar, a baz"),
    ('<p>a <code>x</code><sup>2</sup> <em>c</em> <span class="ad">y</span> z<br>next</p>', "a x2 c y z\nnext"),
    (f'<body><form id="aspnetForm"><input type="hidden"><input name="q"><h1>T</h1>{P * 3}</form></body>', "\n".join(["T", ART, ART, ART])),
    (f'<body><nav>a b</nav><div class="layout sidebar-left"><h1>T</h1>{P * 3}</div></body>', "\n".join(["T", ART, ART, ART])),
    (f'<body><div id="page" class="nav-open"><h1>T</h1>{P}</div></body>', f"T\n{ART}"),
    (f'<body><div class="social-science"><h1>T</h1>{P}</div></body>', f"T\n{ART}"),
    (f'<article>{P}<h2 id="related-work">Related</h2>{P}<h2 id="share-price">Price</h2><p id="form">Form</p></article>',
     "\n".join([ART, "Related", ART, "Price", "Form"])),
    (f'<article>{P}<div class="sharedaddy">Share this</div></article><article class="related-post"><p>Another story</p></article>'
     '<div id="responses"><p>So nice</p></div>', ART),
    (f"<article>{P}<form><input><p>Subscribe now</p></form></article>", ART),
    (f'<body><div class="sidebar"><p>side text</p></div><div id="c"><h1>T</h1>{P * 2}</div></body>', f"T\n{ART}\n{ART}"),
    (f'<div class="post-header"><h1>Head</h1></div><div class="post-body">{P}</div>', f"Head\n{ART}"),
])
def test_ordinary_pages(page, text):
    assert main_text(page) == text


def test_deep_nesting_takes_little():
    assert main_text("<body>" + "<div>" * 50_000 + "deep text") == "deep text"
    assert main_text("<body>" + "<span>" * 50_000 + "</x>" * 50_000 + "deep text") == "deep text"


def test_ratios_choose_without_markup(monkeypatch):
    junk = "<div>" + "<p><a>x</a> <b>y</b></p>" * 8 + "</div>"
    page = f"<body>{junk}<div><h1>T</h1>{'<p>' + 'short but plain text. ' * 2 + '</p>'}{P * 3}<p>The end of it all, so be it.</p></div>{junk}</body>"
    whole = "\n".join(["T", ("short but plain text. " * 2).strip(), ART, ART, ART, "The end of it all, so be it."])
    assert main_text(page) == whole
    own = blocks(page).out
    assert {ART} <= {own[i].text for i in high_blocks(own)} and isinstance(blocks(""), Blocks)
    monkeypatch.setattr("capstan.llm.html_text.smoothed", lambda r, sigma=1.0: r * 0 + 1.0)
    assert main_text(page) != whole


def morse(n, a, b):
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


def test_words_that_polynomials_confuse(spark):
    twelve = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{twelve} {morse(2048, 'a', 'b')}"), (2, f"{twelve} {morse(2048, 'b', 'a')}"), (3, f"{twelve} {morse(2048, 'a', 'b')}")]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.row.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 13}


def test_word_hashes_see_every_byte():
    words = [b"a" * n + c + b"a" * m for n in range(0, 70, 3) for m in range(0, 70, 3) for c in (b"b", b"\xc3\xa9")] + [b"a" * n for n in range(1, 150)]
    for family in (0, 1):
        hashes = substring_dedup.WordHashes([b" ".join(words), b"tail"]).words(family)
        assert len(set(hashes.tolist())) == len(set(words)) + 1
        assert hashes[0] == substring_dedup.WordHashes([b"x " + words[0]]).words(family)[1]


def test_many_texts_and_passages_in_one_call():
    passages = [(i, f"passage {i:08d}") for i in range(250_000)]
    index = decontamination.Index(passages)
    texts = [f"t{i}" for i in range(9_999)] + ["holds passage 00249999 here"]
    got = index.search(texts)
    assert [h["item_id"] for h in got[-1]] == [249_999] and not any(got[:-1])


def test_signs_that_are_no_letters_have_no_language():
    model = language_id.Languages({"en": b"the cat and the dog", "fr": b"le chat et le chien"})
    assert model.predict(["½", "② 12 ⁷", "_ 9", "½ the"])[0] == ["und", "und", "und", "en"]
    assert model.predict(["½ é"])[0] != ["und"]


@pytest.mark.parametrize("hot", [20, 1 << 13])
def test_hot_buckets_are_dealt_again_without_losing_a_link(spark, hot):
    rng = np.random.default_rng(7)
    same = np.uint64(0xABCDEF0123456789)
    fps = set()
    for low in (20, 14):  # fingerprints that differ in the last 20 or 14 bits only, and single ones
        fps |= set((same >> np.uint64(low) << np.uint64(low) | rng.integers(0, 1 << low, 700, dtype=np.uint64)).tolist())
    fps |= set(rng.integers(0, 1 << 63, 300, dtype=np.uint64).tolist())
    f = np.array(sorted(fps), np.uint64)
    forest = simhash._Forest(len(f))
    for i in range(len(f)):
        j = np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1:]) <= 3) + i + 1
        forest.join(np.full(len(j), i), j)
    want = {}
    for i in range(len(f)):
        want.setdefault(forest.find(i), set()).add(int(f[i].view(np.int64)))
    got = {}
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    for r in components(simhash.fingerprint_links(df, hot=hot)).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_masks_agree_more_with_every_deal():
    for max_bits in (1, 3, 6):
        masks = simhash.block_masks(max_bits)
        finer = simhash.block_masks(max_bits, masks[0])
        assert all(m & masks[0] == masks[0] and m != masks[0] for m in finer)
        rng = np.random.default_rng(1)
        for _ in range(200):  # any two fingerprints so close share a finer bucket of each they share
            a = int(rng.integers(0, 1 << 63))
            b = a
            for bit in rng.choice(64, max_bits, replace=False):
                b ^= 1 << int(bit)
            for m in masks:
                if a & m == b & m:
                    assert any(a & x == b & x for x in simhash.block_masks(max_bits, m))
