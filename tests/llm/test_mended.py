"""Cases that once failed: ids shared by texts, messages that ended a job, fits without labels or with few."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoalkit.llm import fingerprint, quality, shingle_join, suffix_dedup, tool_chat, toxicity
from shoalkit.llm.shingle_join import shingle_sets

CHAT = "conv_id long, turn long, role string, text string"


# ---- tool calls ----

def call(own, **more):
    return json.dumps({"tool_calls": [{"id": own, "name": "x", "arguments": {}} | more]})


def test_messages_that_ended_the_job(spark):
    deep = '{"a":' * 3000 + "1" + "}" * 3000
    rows = [(1, 0, "assistant", '{"tool_calls":[{"id":"a","name":"x","arguments":{"q":"\\ud800"}}]}'),
            (1, 1, "tool", '{"tool_call_id":"\\udfff"}'),
            (1, 2, "assistant", '{"tool_calls":[{"id":"b","name":"x","arguments":%s}]}' % deep),
            (1, 3, "assistant", '{"tool_calls":[{"id":"c","name":"x","arguments":%s}]}' % json.dumps(deep)),
            (1, 4, "assistant", '{"tool_calls":[{"id":"d","name":"x","arguments":{"n":NaN}}]}'),
            (1, 5, "assistant", '{"tool_calls":[{"id":"e","name":"x","arguments":{"n":1e999}}]}'),
            (1, 6, "assistant", '{"tool_calls":[{"id":"f","name":"x","arguments":{"n":1.0,"m":1e2,"k":-0.0,"b":0.5,"s":"\\ud83d\\ude00"}}]}'),
            (1, 7, "assistant", '{"tool_calls":[{"id":"\\ud800","name":"\\udc00","arguments":{"n":%s}}]}' % ("9" * 5000))]
    got = {r.turn: r for r in tool_chat.link(spark.createDataFrame(rows, CHAT)).collect()}
    assert len(got) == len(rows)
    assert got[0].json == '{"role":"assistant","tool_calls":[{"arguments":{"q":"\\ud800"},"id":"a","name":"x"}]}' and got[0].n_valid == 1
    assert got[1].answers == "\\udfff" and not got[1].linked
    for t in (2, 4, 5, 7):  # ordinary messages: no JSON within the bounds
        assert json.loads(got[t].json) == {"role": "assistant", "content": rows[t][3]} and got[t].n_calls == 0
    assert (got[3].n_calls, got[3].n_valid) == (1, 0)
    assert '"arguments":{"b":0.5,"k":0,"m":100,"n":1,"s":"😀"}' in got[6].json


@pytest.mark.parametrize("depth, whole", [(tool_chat.DEPTH - 1, True), (tool_chat.DEPTH, False)])
def test_nesting_bound(depth, whole):
    text = "[" * depth + "1" + "]" * depth
    if whole:
        assert tool_chat.read(text)
    else:
        with pytest.raises(ValueError):
            tool_chat.read(text)


def test_levels_of_chains_trees_and_circles(spark, monkeypatch):
    """A chain of 1,000 calls in a few rounds; calls that wait for several; what leads into a circle."""
    rows = [(1, k, "assistant", call(f"c{k}", after=[f"c{k - 1}"] if k else [])) for k in range(1000)]
    r, needs = random.Random(4), {}
    for k in range(60):  # a conversation of calls that need up to three earlier ones
        needs[k] = r.sample(range(k), min(k, r.choice([0, 1, 1, 2, 3])))
        rows.append((2, k, "assistant", call(f"c{k}", after=[f"c{j}" for j in needs[k]])))
    rows += [(3, 0, "assistant", call("a", after=["b"])), (3, 1, "assistant", call("b", after=["a"])), (3, 2, "assistant", call("c", after=["a"])),
             (3, 3, "assistant", call("d", after=["c", "e"])), (3, 4, "assistant", call("e", after=["absent"])), (3, 5, "assistant", call("f", after=["f", "e"]))]
    written = []
    stored = tool_chat.stored
    monkeypatch.setattr(tool_chat, "stored", lambda df, name: written.append(name) or stored(df, name))
    got = {(x.conv_id, x.turn): x.level for x in tool_chat.link(spark.createDataFrame(rows, CHAT)).collect()}
    assert [got[1, k] for k in range(1000)] == [2 * k for k in range(1000)]
    assert written.count("chat-pointers") < 12
    level = {}
    for k in range(60):
        level[k] = max((level[j] + 2 for j in needs[k]), default=0)
    assert {k: got[2, k] for k in range(60)} == level
    assert [got[3, k] for k in range(6)] == [None, None, None, None, 0, 2]


# ---- ids with several texts ----

def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_no_link_is_lost_where_ids_repeat(spark):
    r = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    base = [text(60) for _ in range(12)]
    near = lambda w: " ".join([*w[:-1], "changed"])
    own = lambda w: " ".join(w)
    rows = [(1, own(base[0])), (2, own(base[0])), (2, own(base[1])), (3, near(base[1])), (4, own([*base[1], "more"])),
            (5, own(base[2])), (5, own(base[2])), (6, own(base[3])), (6, own(base[4])), (7, near(base[4])), (7, None), (8, near(base[3])),
            (9, own(base[5])), (10, own(base[6])), (9, near(base[6])), (None, own(base[0])), (11, ""), (11, own(base[7])), (12, "")]
    sets = [(i, set(shingle_sets([t], 4)[1].tolist())) for i, t in rows]
    comp = {i: i for i, _ in rows if i is not None}
    for _ in range(5):
        for i, a in sets:
            for j, b in sets:
                if i is not None and j is not None and a and b and (i == j or 100 * len(a & b) >= 85 * len(a | b)):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert comp[4] == 1 and comp[8] == 6 and comp[10] == 9
    got = shingle_join.jaccard_components(docs_of(spark, rows)).collect()
    assert sorted((x.doc_id or 0, x.n_shingles) for x in got) == sorted((i or 0, len(s)) for i, s in sets)
    assert {x.doc_id: x.component_id for x in got} == comp | {None: None}
    kept = [(x.doc_id, x.text) for x in shingle_join.stage(spark, docs_of(spark, rows), "").collect()]
    assert sorted(kept, key=str) == sorted([(1, rows[0][1]), (5, rows[5][1]), (6, rows[7][1]), (6, rows[8][1]), (9, rows[12][1]), (9, rows[14][1]),
                                            (None, rows[15][1]), (11, ""), (11, rows[17][1]), (12, "")], key=str)


def removed(rows):
    """Per id in order: (bytes removed, hash of what is left), rows of one id are no source for each other."""
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if seen.setdefault(raw[p:p + 50], i) < i:
                gone[p:p + 50] = True
        out.append((i, int(gone.sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def test_rows_with_one_id_in_two_partitions(spark):
    r = random.Random(9)
    part = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared, a, b = part(80), part(120), part(120)
    rows = [(5, a + shared), (5, shared + b), (9, part(30) + shared + part(20)), (5, a + shared)]
    d = docs_of(spark, rows).repartition(4, F.col("text"))
    got = sorted((x.id, x.n_removed, x.kept_sha256) for x in suffix_dedup.dedup(d).collect())
    assert got == removed(rows) and [n for _, n, _ in got][:3] == [0, 0, 0] and got[3][1] >= 80


def test_long_texts_equal_brute_force(spark):
    """Texts of several tiles and hundreds of kB, with passages across tile edges."""
    r = np.random.default_rng(3)
    rand = lambda n: bytes(r.integers(97, 123, n, dtype=np.uint8)).decode()
    one = rand(200_000)
    rows = [(1, one), (2, rand(65_500) + one[65_480:65_700] + rand(70_000)), (3, one[:49] + rand(1000)), (4, rand(130_000) + one[-50:]), (5, "ab" * 60_000), (6, "ba" * 40_000 + rand(10))]
    got = sorted((x.id, x.n_removed, x.kept_sha256) for x in suffix_dedup.dedup(docs_of(spark, rows).repartition(3)).collect())
    assert got == removed(rows) and [n for _, n, _ in got][2:4] == [0, 50]


# ---- classifiers ----

def test_quality_without_labels(spark):
    d = docs_of(spark, [(1, "a text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [x.score for x in quality.score_documents(d, quality.train(d, none)).collect()] == [0.5, 0.5]


def test_curve_falls_at_every_step():
    """Fits that plain Newton steps swing on: separable, few rows, far features."""
    r = np.random.default_rng(7)
    for n, toxic in ((293, 36), (60, 5), (30, 1)):
        y = np.zeros(n)
        y[:toxic] = 1
        x = np.where(y[:, None] > 0, r.normal(8, 4, (n, 4)), r.normal(-11, 0.5, (n, 4))).clip(-12, 12)
        got = toxicity._score(x, toxicity._curve(x, y))
        share = y.mean()
        loss = lambda p: -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
        assert loss(got.clip(1e-9, 1 - 1e-9)) < loss(np.full(n, share))
        assert (got[y == 0] < 0.3).mean() > 0.95
    noise = r.normal(0, 1, (50, 4))
    y = (r.random(50) < 0.1).astype(float)
    assert (toxicity._score(noise, toxicity._curve(noise, y)) < 0.9).all()


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_toxicity_held_out_at_every_size(spark, sf):
    d, lab = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(d, toxicity.train(d, lab)).join(lab, "doc_id")
    held = scored.where("held_out").toPandas()
    assert (held.predicted == held.toxic).mean() >= 0.9
    assert (held[held.toxic == 0].predicted == 0).mean() >= 0.95
    assert (held[held.toxic == 1].predicted == 1).mean() >= 0.5


def test_pipeline_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = dict(corpus_pipeline.STAGES)["toxicity"](spark, d, sf)
    assert kept.count() >= 0.8 * d.count()
    clean = lab.where("toxic = 0")
    assert kept.join(clean, "doc_id", "left_semi").count() >= 0.95 * d.join(clean, "doc_id", "left_semi").count()
    assert corpus_pipeline.run(spark, sf).count() >= 0.5 * d.count()


# ---- pages ----

@pytest.mark.parametrize("html, texts", [
    ("<p>Choose <select><option>x<option>y</select> end</p>", ["Choose end"]),
    ("<p>x <math><mi>a</mi><mo>+</mo><mn>1</mn></math> y</p>", ["x a+1 y"]),
    ("<p>see <object data=x><b>this</b> text</object></p>", ["see this text"]),
    ("<title-block><p>kept</p></title-block><p>too", ["kept", "too"]), ("<select-menu>a</select-menu><p>b</p>", ["a", "b"]),
    ("<p>a</p><svg><path d='x'><p>b</p><p>c</p>", ["a", "b", "c"]), ("<p>a</p><SVG><text>no</text></Svg ><p>b</p>", ["a", "b"]),
    ("<p>a<noscript>b<p>c", ["a", "b", "c"]), ("<p>a</p><script>x<p>y", ["a"]), ("<scripture>a</scripture>", ["a"]),
    ("<svg>" * 3000 + "<p>a" * 3, ["a"] * 3), ("<p>İ<svg>x</svg>b", ["İb"]), ("<p>a<svg>b</svg", ["a"])])
def test_no_content_is_lost(html, texts):
    from shoalkit.llm.html_extract import blocks
    assert [t for _, t, _ in blocks(html)] == texts


def test_long_pages_train_on_all_parts(spark):
    """The boilerplate after a long article is learnt from windows at its end."""
    from shoalkit.llm import html_extract
    body = "".join(f"<p>Paragraph {k} of a long story about rivers and boats.</p>" for k in range(300))
    page = f"<body><nav><a href=/>Home</a></nav><article>{body}</article><footer><p>All rights reserved</p></footer></body>"
    pages = spark.createDataFrame([(k, "u", page.replace("story", f"story{k}")) for k in range(12)], "page_id long, url string, html string")
    got = html_extract.extract(pages, html_extract.train(pages)).first()
    assert got.text.count("\n") == 299 and "rights" not in got.text and "Home" not in got.text


# ---- fingerprints ----

UNSPACED = ("CJK", "HIRAGANA", "KATAKANA", "THAI", "LAO", "KHMER", "MYANMAR")


def symbols(text):
    import unicodedata
    out, run, piece = [], 0, ""
    for c in text + "\0":
        word = unicodedata.category(c)[0] in "LN"
        single = word and (unicodedata.name(c, "").startswith(UNSPACED) or run >= fingerprint.RUN)
        if piece and (not word or single or len(piece) == fingerprint.PIECE):
            out.append(piece)
            piece = ""
        if single or not word and not c.isspace() and c != "\0":
            out.append(c)
        elif word:
            piece += c
        run = run + 1 if word else 0
    return out


def spark_hash(*parts):
    """Spark's xxhash64 of several strings or longs."""
    import xxhash
    h = 42
    for x in parts:
        h = xxhash.xxh64(x.encode() if isinstance(x, str) else int(x).to_bytes(8, "little", signed=True), seed=h).intdigest()
    return h - (1 << 64) if h >= 1 << 63 else h


def anchors_of(text):
    s, k, inner = symbols(text), fingerprint.K, fingerprint.S
    if len(s) < k:
        return [(0, spark_hash(" ".join(s)))] if s else []
    sub = [spark_hash(*s[i:i + inner]) for i in range(len(s) - inner + 1)]
    last = k - inner
    at = [i for i in range(len(s) - k + 1) if min(sub[i], sub[i + last]) <= min(sub[i + 1:i + last])]
    return [(i, spark_hash(*[sub[i + j] for j in range(0, last + 1, inner)])) for i in at]


def test_anchors_and_likeness_recomputed(spark):
    r = random.Random(12)
    words = ["".join(r.choice("abcdeé1") for _ in range(r.randint(1, 9))) for _ in range(50)]
    text = " ".join(r.choice(words) for _ in range(300))
    han = "".join(chr(r.randint(0x4E00, 0x9000)) for _ in range(400))
    long = "".join(r.choice("abcdefghij") for _ in range(300))
    half = text.split()
    texts = [text, han, long, "x" + han, "x" + long, "", "one", "a, b. c! d", " ".join(half[150:] + half[:150]), text + " " + text, "ぁあ漢字 abc漢def" * 9, " \t\n"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got: dict = {}
    for x in fingerprint.positions(d).collect():
        got.setdefault(x.doc_id, []).append((x.at, x.anchor))
    want = {i: anchors_of(t) for i, t in enumerate(texts) if anchors_of(t)}
    assert {i: sorted(v) for i, v in got.items()} == want
    sets = {i: {h for _, h in anchors_of(t)} for i, t in enumerate(texts)}
    jaccard = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert jaccard(1, 3) > 0.9 and jaccard(2, 4) > 0.7  # one inserted character keeps most anchors of unspaced text
    pairs = spark.createDataFrame([(0, 0), (0, 8), (0, 9), (1, 3), (5, 11), (0, 5)], "a int, b int")
    named = d.select("doc_id", fingerprint._anchors_of("text").alias("n"))
    both = pairs.join(named.withColumnRenamed("n", "x"), F.col("a") == F.col("doc_id")).drop("doc_id").join(named.withColumnRenamed("n", "y"), F.col("b") == F.col("doc_id"))
    rows = {(q.a, q.b): (q.flat, q.chain) for q in both.select("a", "b", fingerprint.likeness(F.col("x"), F.col("y")).alias("flat"), fingerprint.chain_likeness(F.col("x"), F.col("y")).alias("chain")).collect()}
    assert rows[0, 0] == (1.0, 1.0) and rows[5, 11] == (1.0, 1.0) and rows[0, 5] == (0.0, 0.0)
    assert rows[1, 3][0] == jaccard(1, 3)
    assert rows[0, 9][0] > 0.9 and rows[0, 9][1] < 0.6  # a text twice
    assert rows[0, 8][1] < rows[0, 8][0]  # passages in another order
    for (a, b), (_, chain) in rows.items():
        links = [{}, {}]
        for n, i in ((0, a), (1, b)):
            h = [x for _, x in anchors_of(texts[i])]
            for p, q in zip(h, [*h[1:], 0]):
                links[n][p, q] = links[n].get((p, q), 0) + 1
        links = [{key: min(v, 4) for key, v in x.items()} for x in links]
        shared = sum(min(v, links[1].get(key, 0)) for key, v in links[0].items())
        total = sum(links[0].values()) + sum(links[1].values()) - shared
        assert chain == (shared / total if total else 1.0)
