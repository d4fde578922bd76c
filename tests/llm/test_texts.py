"""Main texts, licences, chat formatting and the pipeline."""

import hashlib
import os
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import chat, licenses, main_text, mixture, pii, queries
from quire.llm.tagger import KINDS, train
from quire.llm.words import utf8, word_hashes

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a&nbsp;b<p>c<br>d</p>e", "a b c d e"),
        ('<div class="sidebar">x</div><main><h1>T</h1><p>one <b>two</b>three</main><footer>f', "T one twothree"),
        ("<body><header>h</header><p>text<form><input>q</form> more</p><div id='comments'><p>c1</div></body>", "text more"),
        ("plain < text &amp; x &lt;p&gt;", "plain < text & x <p>"),
        ('<article><p>x<script>if(a<b)"</p>"</script>y</p><aside>no</aside></article><article>second</article>', "xy second"),
        ("<nav><ul><li>a</ul></nav><article><h1>H</h1><p><b>open<br><p>next</p></article><footer>&copy;</footer>", "H open next"),
        ("<!-- c --><style>p{}</style><title>t</title><p hidden>h</p><p>v", "v"),
        ('<article><div class="elementor-widget elementor-widget-theme-post-content"><p>Whole body text.</p></div></article>', "Whole body text."),
        ('<article><p>The text of it</p><div class="share-price side effect">and a price</div></article>', "The text of it and a price"),
        ('<div class="page widget"><article><p>all that there is here</p><div class="share">tell</div><div class="comments widget">a long thread that readers wrote below</div></article></div>', "all that there is here"),
        ('<p>text that is longer than</p><div class="cookie-consent">c</div><div class="notice">n</div><ul class="nav-links main"><li>l</ul><div class="social-share-buttons">s</div><div id="respond">r</div>', "text that is longer than"),
        ("", ""),
        (None, ""),
    ],
)
def test_blocks(page, want):
    assert " ".join(t for _, t in main_text.blocks(page or "")) == want


def test_repeated_runs_are_boilerplate(spark):
    notice = "please sign up for our daily letter and read more of this every day"
    rows = [(i, f"http://h.example/{i}", f"<p>{notice}</p><p>{i} has a page with its own words</p>") for i in range(8)]
    rows += [(100 + i, "http://h.example/copy", "<p>the same page comes many times with all of its words unchanged here</p>") for i in range(6)]
    rows += [(200 + i, "http://art.example/x", f"<article><p>{notice}</p><p>text {i}</p></article>") for i in range(6)]
    rows += [(300, None, None), (301, "odd url", "<p>alone"), (301, "odd url", "<p>alone")]
    got = main_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert text[3] == "3 has a page with its own words"
    assert text[103].startswith("the same page") and text[204] == "text 4" and text[300] == "" and text[301] == "alone"


def test_hosts_of_many_groups_are_judged_as_a_whole(spark, monkeypatch):
    notice, half = "please sign up for our daily letter and read more of this", "this line is in more than half of the articles here"
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(12))
    rare = lambda i: "a run that only two of the many pages of this host have" if i in (3, 90) else ""
    rows = [(i, f"http://h.example/{i}", f"<script>{'x' * 2000}</script><p>{own(i)}</p><p>{notice if i % 5 == 0 else ''}</p><p>{rare(i)}</p>") for i in range(100)]
    rows += [(200 + i, f"http://h.example/copy{i}", f"<p>{own(200)} copies of a page count once</p>") for i in range(30)]
    rows += [(300 + i, f"http://a.example/{i}", f"<article><p>{own(i)}</p><p>{half if i % 3 else ''}</p><p>{notice if i < 15 else ''}</p></article>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    whole = {r.page_id: r.text for r in main_text.main_texts(pages).collect()}
    monkeypatch.setattr(main_text, "GROUP_CHARS", 300)
    monkeypatch.setattr(main_text, "GROUP_PAGES", 10)
    got = {r.page_id: r.text for r in main_text.main_texts(pages).collect()}
    assert got == whole and len(got) == len(rows)
    assert got[5] == own(5) and got[3].endswith("this host have") and got[201].endswith("count once") and got[301] == f"{own(1)} {notice}"


def test_main_text_of_no_page_and_of_long_ones(spark):
    kinds = "page_id long, url string, html string"
    assert main_text.main_texts(spark.createDataFrame([], kinds)).count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(i, "http://l.example/x", f"<p>{long} {i}</p><p>{long}</p>") for i in (1, 1, 2)] + [(None, None, "<p>x")]
    got = main_text.main_texts(spark.createDataFrame(rows, kinds)).collect()
    # on two distinct pages only, nothing is boilerplate
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, "x")] + [(i, f"{long} {i} {long}") for i in (1, 1, 2)]


def test_repeated_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(30):
        tokens, page = rng.integers(0, 3, 60), np.sort(rng.integers(0, 5, 60))
        rank, count = main_text.repeated(tokens, page, 4)
        where: dict = {}
        for i in range(57):
            if page[i] == page[i + 3]:
                where.setdefault(tuple(tokens[i : i + 4]), set()).add(page[i])
        for i in range(60):
            inside = i < 57 and page[i] == page[i + 3]
            assert (rank[i] >= 0) == inside and (not inside or count[rank[i]] == len(where[tuple(tokens[i : i + 4])]))


def test_licences(spark):
    long = "some text of its own that goes on and on " * 30
    rows = [
        ("a/LICENSE", f"Released under the MIT License.\n{long}"), ("a/b/c.py", "x = 1"), ("a/b/d/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("a/b/d/e/f.py", None), ("z.txt", ""),
        (None, "Licensed under CC BY-NC 4.0."), ("a/b/g.py", f"# SPDX-License-Identifier: Apache-2.0\n{long}"), ("a/x.txt", f"{long}. Licensed under the Apache License, Version 2.0. {long}"), ("a/b/c.py", "x = 1"), ("q/a.py", "the license of this is unknown"),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    found = {r.path: (r.license, r.own, r.directory) for r in got}
    assert found == {
        "a/LICENSE": ("MIT", True, None), "a/b/c.py": ("MIT", False, "a"), "a/b/d/COPYING": ("GPL-3.0", True, None), "a/b/d/e/f.py": ("GPL-3.0", False, "a/b/d"), "z.txt": (None, False, None),
        None: ("CC-BY-NC-4.0", True, None), "a/b/g.py": ("Apache-2.0", True, None), "a/x.txt": ("Apache-2.0", True, None), "q/a.py": (None, False, None),
    }
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_anchors_miss_no_line(spark):
    m = licenses.Matcher(licenses.TEMPLATES, 1000, {"the": 900, "license": 10, "of": 800})
    for name, text in licenses.TEMPLATES:
        low = text.encode().lower()
        product, template, known, others = m.best(licenses.terms(text))
        assert product / known**0.5 == pytest.approx(1.0) and m.names[template] == name and not others
        found = max(m.scan(low, sorted(low.find(a.encode()) for a in m.anchors if a.encode() in low)), key=lambda s: (s[0] / s[2] ** 0.5, s[4]))
        assert m.names[found[1]] == name
        # without its anchors a template is below the threshold
        v = m.vectors[licenses.TEMPLATES.index((name, text))]
        assert sum(x * x for w, x in v.items() if w not in m.anchors) < licenses.THRESHOLD**2
    assert len(word_hashes(*utf8(__import__("pyarrow").array(["a.b, c"])), licenses.PARTS)[0]) == 3


def test_licence_scores_equal_the_cosine_over_all_terms(spark, monkeypatch):
    """Single lines: each score by its definition, with the frequencies of all terms in all files."""
    import math
    import random
    from collections import Counter

    rng = random.Random(3)
    common = ["the", "and", "file", "see", "here"]
    texts = []
    for name, t in licenses.TEMPLATES[:12]:
        for extra in range(5):
            words = t.rstrip(".").split() + [rng.choice(common) for _ in range(extra)] + [f"rare{rng.randrange(10**6)}" for _ in range(extra % 3)]
            texts.append(" ".join(words).replace(".", " ").replace(";", " ").replace("!", " ").replace("?", " "))
    texts += [" ".join(rng.choice(common) for _ in range(20)) for _ in range(40)] + ["", "license"]
    df = Counter(w for t in texts for w in set(licenses.terms(t)))
    idf = lambda w: 1 + math.log((len(texts) + 1) / (df[w] + 1))

    def vector(t):
        v = {w: c * idf(w) for w, c in Counter(licenses.terms(t)).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    templates = [(n, vector(t)) for n, t in licenses.TEMPLATES]
    rows = [(f"d{i}/x", t) for i, t in enumerate(texts)]
    for few in (licenses.FEW_ROWS, 0):
        monkeypatch.setattr(licenses, "FEW_ROWS", few)
        got = {r.path: r for r in licenses.scan(spark.createDataFrame(rows, "path string, text string").repartition(3)).collect()}
        for p, t in rows:
            v = vector(t)
            score, name = max(((sum(x * v.get(w, 0.0) for w, x in u.items()), -i, n) for i, (n, u) in enumerate(templates)), default=None)[::2]
            if score >= licenses.THRESHOLD:
                assert got[p].license == name and abs(got[p].score - score) < 1e-9
            else:
                assert not got[p].own and got[p].score == 0.0
    assert sum(r.own for r in got.values()) > 30


def test_licences_of_ties_and_deep_folders(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/COPYING", "Licensed under CC0 1.0 Universal, public domain dedication."), ("a/b/c/d/e/f.py", ""), ("a/b/NOTICE.txt", "nothing of note"), ("x/full.txt", licenses.TEMPLATES[19][1].replace(", ", ",\n")), ("x/y.py", "")]
    got = {r.path: (r.license, r.own, r.directory) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    # of equal matches the name decides
    assert got["a/b/c/d/e/f.py"] == ("CC0-1.0", False, "a") and got["a/b/NOTICE.txt"] == ("CC0-1.0", False, "a")
    assert got["x/full.txt"] == ("MIT", True, None) and got["x/y.py"] == ("MIT", False, "x")


TURNS = [
    (1, 0, "system", "be # good"), (1, 1, "user", "a\\"), (1, 2, "assistant", "\\\\m ###### \\</turn></turn>\n#"), (2, 0, "user", "x"), (2, 0, "user", "x"), (3, None, None, None), (3, 5, "tool:a###", "</turn"), (3, 1, "assistant", ": é"),
    (None, 0, "user", "q"), (None, 1, "assistant", ""),
]


def test_chat_reads_back(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("t", F.lit("clash"))
    rows = {r.conv_id: r for r in chat.formatted(df).withColumn("back", chat.parsed(F.col("formatted"))).collect()}
    assert [tuple(t) for t in rows[1].back] == [t[2:] for t in TURNS[:3]]
    assert [tuple(t) for t in rows[3].back] == [("", ""), ("assistant", ": é"), ("tool:a###", "</turn")]
    assert {k: r.error_turn for k, r in rows.items()} == {1: None, 2: 1, 3: 0, None: None}
    for r in rows.values():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("</turn>\n") == r.n_turns
    assert [s.text for s in rows[1].segments if s.loss] == ["\\\\\\\\m \\m\\m \\\\\\e\\e\n#"]


def test_chat_digests_of_the_probe(spark):
    df = chat.with_probe(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    r = chat.formatted(df).withColumn("back", chat.parsed(F.col("formatted"))).first()
    assert [tuple(t) for t in r.back] == [("user", chat.PROBE[1]), ("assistant", chat.PROBE[1])] and r.error_turn is None


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), c.execute(queries.SQL[name]).df()
    cols = sorted(got.columns)
    show = lambda df: sorted(tuple("~" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None))
    assert cols == sorted(want.columns) and show(got) == show(want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline(spark):
    """Each stage of a run against what its operator says on the stage's own input."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    now, kept, after = docs, [], []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, DATA).checkpoint()
        if i < 4:
            assert now.columns == docs.columns
        after.append({r.doc_id: r for r in now.collect()})
        kept.append([r.doc_id for r in now.collect()])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [i for i in rows if labels.get(i) == 1]
    assert len(set(good) - set(kept[0])) <= 0.05 * len(good)
    assert not any(i for i in kept[0] if labels.get(i) == 0)
    texts = [rows[i].text for i in kept[1]]
    assert len(texts) == len(set(texts)) and set(kept[1]) <= set(kept[0]) and set(kept[3]) == set(kept[2]) <= set(kept[1])
    redone = {r.doc_id: r for r in now.collect()}
    assert not any("@mail" in r.text for r in redone.values()) and all(r.n_chars == len(r.text) for r in redone.values())
    whole = corpus_pipeline.run(spark, DATA)
    assert sorted((r.doc_id, r.copy) for r in whole.collect()) == sorted((r.doc_id, r.copy) for r in now.collect())


    # personal data and mixture by their definitions, on their own inputs
    tagger = train()
    for i, r in after[2].items():
        text, end, want = r.text, 0, ""
        for kind, a, b in sorted(pii.find_spans([text or ""], tagger)[0][1], key=lambda x: (x[1], -x[2])):
            want += text[end:a] + f"<{KINDS[kind]}>" if a >= end else ""
            end = max(end, b)
        assert after[3][i].text == want + text[end:] and after[3][i].n_chars == len(after[3][i].text)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in after[3].items()}
    of = Counter()
    for i, r in after[3].items():
        of[r.source] += size[i]
    order = sorted((x for x in of if x is not None)) + [x for x in of if x is None]
    weight, full = {x: (5, 2, 1)[n % 3] for n, x in enumerate(order)}, set()
    while True:
        rest = [x for x in order if x not in full]
        level = (1.5 * sum(of.values()) - sum(2 * of[x] for x in full)) / max(1, sum(weight[x] for x in rest))
        if not (over := {x for x in rest if level * weight[x] > 2 * of[x]}):
            break
        full |= over
    copies = Counter()
    for i, r in after[3].items():
        rate = (2.0 * of[r.source] if r.source in full else level * weight[r.source]) / max(1, of[r.source])
        copies[i] = int(rate) + (int(hashlib.md5(f"mix-1:{i}".encode()).hexdigest()[:8], 16) / 2**32 < rate - int(rate))
    assert Counter(kept[4]) == +copies


def test_mixed_text_hash_is_stable(spark):
    """The draw depends on the seed and the id alone."""
    row = spark.range(1).select(mixture._unit("mix-1", F.lit(42)).alias("u")).first()
    assert row.u == int(hashlib.md5(b"mix-1:42").hexdigest()[:8], 16) / 2**32
