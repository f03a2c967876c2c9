"""Corpus operators on small hostile tables, against brute force where it is defined."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoalkit.llm import (QUERIES, decontaminate, fingerprint, html_extract, mixing, quality, shingle_join, suffix_dedup,
                          token_count, tool_chat, toxicity)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, id string, n string, win string, size string, sig string, b string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *["x"] * 7) for i, t, s in rows], SCHEMA)


def sample():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = [text(r.randint(0, 120)) for _ in range(25)]
    shared = text(20)
    out = base + [b.upper() for b in base[:5]] + base[5:9] + [base[9] + " tail", "head " + base[10], shared + " " + base[11], base[12] + " " + shared]
    for b in base[13:20]:
        w = b.split()
        if w:
            w[r.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [None, "", "   ", "one", "two words", "a" * 400, "a" * 400 + "b", "日本語" * 40, "x <|endoftext|> y", text(3000)]
    rows = [(k, t, ["s1", "s2", None][k % 3]) for k, t in enumerate(out)]
    return rows + [rows[3], rows[30]]


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, sample()).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).cache()


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("k,percent", [(4, 85), (2, 75)])
def test_jaccard_components(docs, empty, k, percent):
    rows = {i: t for i, t, _ in sample()}
    sets, up = {i: shingles(t, k) for i, t in rows.items()}, {i: i for i in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in rows:
        for j in rows:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    got = shingle_join.jaccard_components(docs, k, percent).collect()
    assert len(got) == len(sample())
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root(r.doc_id)) for r in got)
    assert shingle_join.jaccard_components(empty, k, percent).count() == 0


def test_deletion_neighbourhoods_lose_no_link():
    plan, r = shingle_join.Plan(75), np.random.default_rng(1)
    assert any((plan.scheme(b) or (0, False))[1] for b in range(25))
    for n in (3, 6, 10, 25, 60, 200):
        for _ in range(40):
            x = r.integers(0, 2 ** 63, n).astype(np.uint64)
            y = np.concatenate([x[r.integers(0, n // 5 + 1):], r.integers(0, 2 ** 63, int(r.integers(0, n // 5 + 1))).astype(np.uint64)])
            x, y = np.unique(x), np.unique(y)
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= 75 * (len(x) + len(y) - both) and len(np.setxor1d(x, y)):
                a, b = shingle_join.signatures(plan, np.array([0, len(x), len(x) + len(y)]), np.concatenate([x, y]))
                assert len(np.intersect1d(a, b)), (n, len(x), len(y), both)


@pytest.mark.parametrize("heavy", [suffix_dedup.HEAVY, 20])
def test_suffix_dedup_split_keys(docs, heavy):
    """A hot line with different text around it: every key's windows are dealt singly with the low limit."""
    line = "this very line of about eighty bytes stands in every second document, whole. "
    rows = [(k, t, s) for k, t, s in sample()] + [(100 + k, f"{k * 7919} {'xyz'[k % 3]} {line if k % 2 else ''}{k * 104729} end", None) for k in range(300)]
    want, seen = {}, {}
    for i, t in sorted({i: t for i, t, _ in rows}.items()):
        b = (t or "").encode()
        w = [b[p:p + 50] for p in range(len(b) - 49)]
        gone = np.zeros(len(b), bool)
        for p, x in enumerate(w):
            if seen.setdefault(x, i) < i:
                gone[p:p + 50] = True
        want[i] = (len(b), int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    got = suffix_dedup.dedup(frame(docs.sparkSession, rows), heavy=heavy).collect()
    assert len(got) == len(rows) and all((r.n_bytes, r.n_removed, r.kept_sha256) == want[r.id] for r in got)


def test_heavy_key_is_split_over_shards():
    """Fragments of one hot key, all different, fill no single shard."""
    r = random.Random(3)
    side = lambda: "".join(r.choice("abcdefgh") for _ in range(60))
    texts = [f"{side()} a very common line of some sixty bytes for the hot key here {side()}".encode() for _ in range(400)]
    pack = next(suffix_dedup._pack([suffix_dedup.pd.DataFrame({"id": range(400), "text": [t.decode() for t in texts], "rest": None})]))
    row = next(pack.itertuples())
    keys = suffix_dedup._shared(500)(next(suffix_dedup._hashes(50, 1)([pack])))
    assert keys["split"].sum() > 500
    keys["windows"] = None
    windows = suffix_dedup._shared(1 << 62)(suffix_dedup._singles(50, 1)(pack, keys))
    known = suffix_dedup._keys_of(suffix_dedup.pd.concat([keys, windows[["chunk", "keys"]].rename(columns={"keys": "windows"})]))
    frags, shard, _ = suffix_dedup._runs(row, known, 50, 64)[4:]
    every = {}
    for d, t in enumerate(texts):
        for p in range(len(t) - 49):
            every.setdefault(t[p:p + 50], set()).add(d)
    repeated = {w for w, d in every.items() if len(d) > 1}
    assert repeated and repeated <= {f[p:p + 50] for f in frags for p in range(len(f) - 49)}
    largest = lambda frags, shard: np.bincount(shard, [len(f) - 49 for f in frags]).max()
    whole = suffix_dedup._runs(row, (known[0], known[0][:0], known[2]), 50, 64)[4:6]
    assert largest(frags, shard) <= 1000 and largest(*whole) > 3000


def test_suffix_dedup(docs, empty):
    want, seen = {}, {}
    for i, t in sorted({i: t for i, t, _ in sample()}.items()):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if seen.get(b[p:p + 50], i) < i:
                gone[p:p + 50] = True
        for p in range(len(b) - 49):
            seen.setdefault(b[p:p + 50], i)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        want[i] = (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()), hashlib.sha256(kept).hexdigest())
    got = suffix_dedup.dedup(docs).collect()
    assert len(got) == len(sample())
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.id] for r in got)
    assert suffix_dedup.dedup(empty).count() == 0
    kept = suffix_dedup.stage(docs.sparkSession, docs, SF)
    assert kept.columns == docs.columns and kept.where("text like '%aaaa%'").count() == 1


def test_suffix_order_and_spilled_queues(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MEMORY", 7)
    for seed in range(60):
        r = random.Random(seed)
        k = r.choice([1, 2, 4])
        t = np.array([r.randint(1, k) for _ in range(r.randint(1, 150))] + [0], dtype=np.int16)
        assert suffix_dedup.suffix_order(t, k + 1, 400).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_token_counts(docs, empty):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    tok = tokenizers.Tokenizer.from_file(path)
    hard = ["I'll've  \t\n x y\u0085z  ", "<|endoftext|><|endoftext|>", "1234567 ½ ²", "🙂🙂 a‍b", "\x00\x1f\x1c"]
    count = token_count.counter(json.load(open(path)))
    assert [count(t) for t in hard] == [len(tok.encode(t, add_special_tokens=False).ids) for t in hard]
    want = {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t, _ in sample()}
    got = token_count.token_counts(docs, path).collect()
    assert len(got) == len(sample()) and all(r.n_tokens == want[r.doc_id] and r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_count.token_counts(empty, path).count() == 0


def test_decontaminate(spark, docs, empty):
    rows = sample()
    long = next(t for _, t, _ in rows if t and len(t.split()) > 60)
    items = spark.createDataFrame([(1, " ".join(long.split()[10:35]).upper(), 0), (2, "two WORDS", 0), (3, None, 0), (4, "...", 0), (None, "two words", 0), (2, "two WORDS", 0)], "item_id long, text string, h int")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = {tuple(w[s:s + min(10, len(w))]) for t in (items.collect()) for w in [word.findall((t.text or "").translate(LOW))] if w for s in range(len(w) - min(10, len(w)) + 1)}
    for limit in (decontaminate.BROADCAST_BYTES, -1):  # broadcast and shuffled prefixes
        decontaminate.BROADCAST_BYTES, old = limit, decontaminate.BROADCAST_BYTES
        got = decontaminate.decontaminate(docs, items).collect()
        decontaminate.BROADCAST_BYTES = old if limit == -1 else limit
        texts = {i: t for i, t, _ in rows}
        assert len(got) == len(rows)
        for r in got:
            w = word.findall((texts[r.doc_id] or "").translate(LOW))
            hit = {q for s in range(len(w)) for n in {len(x) for x in wins} if s + n <= len(w) and tuple(w[s:s + n]) in wins for q in range(s, s + n)}
            assert (r.n_words, r.n_hit, r.contaminated) == (len(w), len(hit), bool(hit))
        decontaminate.BROADCAST_BYTES = 32 << 20
    assert decontaminate.decontaminate(empty, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


def test_fingerprints(docs, empty, monkeypatch):
    rows = sorted(sample(), key=lambda r: (r[0], r[1] or ""))
    texts = [t or "" for _, t, _ in rows]
    want = {}
    for k, t in enumerate(texts):
        nxt, half = texts[(k + 1) % len(texts)], len(t) // 2
        want.setdefault(rows[k][0], set()).add(hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest())
    for size in (fingerprint.BUCKET_CHARS, 2000):  # one bucket, several buckets
        monkeypatch.setattr(fingerprint, "BUCKET_CHARS", size)
        got = fingerprint.fingerprints(docs).collect()
        assert len(got) == len(rows) and all(r.edited_sha256 in want[r.doc_id] for r in got)
        by: dict = {}
        for r in got:
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert by.setdefault(dict((i, t) for i, t, _ in rows)[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert fingerprint.fingerprints(empty).count() == 0


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(sample()) and all(0 <= r.taken <= 2 * r.size for r in got)
    total, top = {}, {}
    for r in got:
        total[r.target] = total.get(r.target, 0) + r.taken
        top[r.target] = max(top.get(r.target, 0), r.size)
    assert all(abs(total[t] - t) <= 2 * top[t] + 1 for t in total)
    assert abs(sum({(r.source_size, r.target): r.target for r in got}.values()) - 1.5 * sum(r.size for r in got)) < 1e-6 * sum(r.size for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs).collect()))
    assert mixing.mix(empty).count() == 0


def test_classifiers(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0, 1) for i in range(40)], "doc_id long, quality int, toxic boolean, n int").withColumn("toxic", F.col("toxic").cast("int"))
    for run in (lambda d, lab: quality.score_documents(d, quality.train(d, lab)), lambda d, lab: toxicity.score_documents(d, toxicity.train(d, lab))):
        got = run(docs, labels).collect()
        assert len(got) == len(sample()) and all(0 <= r.score <= 1 for r in got)
        assert run(empty, labels).count() == 0
        assert run(docs, labels.limit(0)).count() == len(sample())


def test_quality_and_toxicity_held_out(spark):
    d, lab = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    q = quality.score_documents(d, quality.train(d, lab)).join(lab, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    t = toxicity.score_documents(d, toxicity.train(d, lab)).join(lab, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert q >= 0.95 and t >= 0.9


def test_html(spark):
    page = ("<html><head><title>T &amp; x</title><script>if(a<b){'</p>'}</script></head><body><nav><ul><li><a href='/'>Home</a><li>About</ul></nav>"
            "<div class=\"ad\">Buy now</div><article><h1>Head</h1><p>One&nbsp;<b>two\n three<p>Four &lt;five&gt;<br>six</article><footer>&copy; foot</footer>")
    pages = spark.createDataFrame([(k, "u", page.replace("Head", f"Head {k}"), 1) for k in range(30)] + [(98, None, None, 1), (99, "u", "", 1)], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in html_extract.extract(pages, html_extract.train(pages)).collect()}
    assert got[5] == "Head 5\nOne two three\nFour <five> six" and got[98] == got[99] == ""
    assert html_extract.extract(pages.limit(0), html_extract.train(pages.limit(0))).count() == 0


def test_tool_chat(spark):
    call = lambda i, args, **x: {"id": i, "name": "add", "arguments": args} | x
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", json.dumps({"tool_calls": [call("a", {"x": 1}), call("b", {"x": {"$ref": "a"}})]})),
            (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "ü"})), (1, 3, "tool", '{"tool_call_id":"b"}'), (1, 4, "tool", '{"tool_call_id":"zz"}'),
            (2, 0, "assistant", json.dumps({"tool_calls": [call("c", {}, after=["d"]), call("d", {}, after=["c"])]})), (None, None, None, None), (2, 1, "user", "{bad")]
    schemas = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": ["integer", "object"]}}}}
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, calls int")
    got = {(r.conv_id, r.turn): r for r in tool_chat.link(df, schemas).collect()}
    assert len(got) == len(rows)
    assert (got[1, 1].n_calls, got[1, 1].n_valid, got[1, 1].level) == (2, 2, 2)
    assert (got[1, 2].linked, got[1, 2].call_turn, got[1, 2].level) == (True, 1, 1) and got[1, 3].level == 3
    assert not got[1, 4].linked and got[2, 0].level is None and got[2, 0].n_valid == 0
    assert got[1, 2].json == '{"content":"ü","role":"tool","tool_call_id":"a"}'
    assert got[None, None].json == '{"content":"","role":"unknown"}'
    assert tool_chat.link(df.limit(0)).count() == 0


def corpus():
    """Documents by id: clean ones, toxic ones, copies, near copies, shared passages, benchmark passages; and the items."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(900)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [text(25) for _ in range(4)]
    docs = {k: text(r.randint(60, 120)) for k in range(160)}
    toxic = set(range(200, 280))
    docs |= {k: " ".join([*text(40).split(), *(r.choice(["vilewordone", "vilewordtwo", "vilewordthree"]) for _ in range(12)), *text(20).split()]) for k in toxic}
    docs |= {300 + k: docs[k] for k in range(5)}
    for k in range(5, 11):
        w = docs[k].split()
        w[len(w) // 2] = "changed"
        docs[300 + k] = " ".join(w)
    passage = text(30)
    docs |= {320 + k: f"{text(50)} {passage} {text(40)}" for k in range(6)}
    docs |= {340 + k: f"{text(30)} {items[k]} {text(30)}" for k in range(4)}
    return docs, toxic, items


def test_pipeline_stages(spark, tmp_path):
    texts, toxic, items = corpus()
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in texts if i < 280], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "mixing"]
    cols, docs = ["doc_id", "text", "lang", "source", "n_chars"], spark.read.parquet(f"{sf}/documents.parquet")

    def after(name):
        nonlocal docs
        docs = stages[name](spark, docs, sf).cache()
        got = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == cols and len(got) == docs.count()
        assert all((r.lang, r.source, r.n_chars) == ("en", f"s{i % 3}", len(r.text)) for i, r in got.items())
        return {i: r.text for i, r in got.items()}

    want = {i: t for i, t in texts.items() if i not in toxic}
    assert after("toxicity") == want

    sets, first = {i: shingles(t, 5) for i, t in want.items()}, {}
    for i in sorted(sets):  # groups of the planted copies are pairs, the first document stays
        first[i] = next((j for j in sorted(sets) if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])), i)
    assert sum(i != j for i, j in first.items()) == 11
    want = {i: t for i, t in want.items() if first[i] == i}
    assert after("ngram_jaccard_join") == want

    seen, cut = {}, {}
    for i, t in sorted(want.items()):
        b, gone = t.encode(), set()
        for p in range(len(b) - 49):
            if seen.setdefault(b[p:p + 50], i) < i:
                gone |= set(range(p, p + 50))
        cut[i] = bytes(c for p, c in enumerate(b) if p not in gone).decode()
    assert sum(cut[i] != want[i] for i in cut) == 5
    assert after("suffix_array_dedup") == cut

    wins = {tuple(w[s:s + 10]) for w in map(str.split, items) for s in range(len(w) - 9)}
    want = {i: t for i, t in cut.items() if not any(tuple(t.split()[s:s + 10]) in wins for s in range(len(t.split()) - 9))}
    assert set(cut) - set(want) == {340, 341, 342, 343}
    assert after("benchmark_decontamination") == want

    mixed = stages["mixing"](spark, docs, sf).collect()
    assert {r.doc_id: r.size for r in mixed} == {i: len(t.split()) for i, t in want.items()} and len(mixed) == len(want)
    total, top = {}, {}
    for r in mixed:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        total[r.target], top[r.target] = total.get(r.target, 0) + r.taken, max(top.get(r.target, 0), r.size)
    assert all(abs(total[t] - t) <= 2 * top[t] + 1 for t in total)
    whole = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert len(whole) == len(mixed) and all(tuple(whole[r.doc_id])[:-1] == tuple(r)[:-1] and whole[r.doc_id].rate == pytest.approx(r.rate) for r in mixed)


@pytest.mark.parametrize("text, ids, answers", [
    ('{"tool_calls":[{"id":7,"name":"add","arguments":{"x":1}}]}', ["7"], None),
    ('{"tool_calls":[{"id":"a","function":{"name":"add","arguments":"{\\"x\\":1}"}}]}', ["a"], None),
    (' \n{"tool_calls":[{"id":"a","name":"add","arguments":{"x":1}}]}', ["a"], None),
    ('{"tool_call_id":7}', [], "7"), ('{"tool_call_id":true}', [], None)])
def test_tool_call_forms(text, ids, answers):
    got = tool_chat.parse("assistant", text, {"add": {"required": ["x"]}})
    assert ([c["id"] for c in got["calls"]], got["answers"]) == (ids, answers)
    assert all(c["valid"] and c["name"] == "add" for c in got["calls"])


def test_derived_tool_calls(spark):
    given = [(r.conv_id, r.turn, r.role, r.text) for r in tool_chat.table(spark, SF, "conversations").collect()]
    given += [(-c, t, ["user", "assistant"][t % 2], f"some words {c} {t} \"é\\") for c in range(1, 40) for t in range(12)]
    given += [(None, 1, "assistant", None), (-99, None, "assistant", "x"), (-99, 3, None, None)]
    chats = tool_chat.derived(spark.createDataFrame(given, "conv_id long, turn long, role string, text string"))
    schemas = tool_chat.schema_table(chats)
    rows, calls, bodies = chats.collect(), {}, {}
    for r in rows:
        body = json.loads(r.text) if (r.text or "").strip()[:1] == "{" else {}
        bodies[r.conv_id, r.turn] = body
        for c in body.get("tool_calls", []):
            f = c.get("function", c)
            try:
                args = json.loads(f["arguments"]) if isinstance(f["arguments"], str) else f["arguments"]
            except ValueError:
                args = None
            needs = set(c.get("after", [])) | ({args["from"]["$ref"]} if args and "from" in args else set())
            top = schemas[f["name"]]["properties"]["limit"]["maximum"]
            ok = args is not None and isinstance(args.get("query"), str) and isinstance(args["limit"], int) and 1 <= args["limit"] <= top
            calls.setdefault((r.conv_id, str(c["id"])), []).append((r.turn, ok, needs))
    first = {k: min(v, key=lambda x: x[0]) for k, v in calls.items()}
    level = {}
    for _ in first:
        for (c, i), (_, _, needs) in first.items():
            known = [(c, n) for n in needs if n != i and (c, n) in first]
            if all(n in level for n in known):
                level[c, i] = max([level[n] + 2 for n in known], default=0)
    got = tool_chat.link(chats, schemas).collect()
    assert len(got) == len(given)
    seen = set()
    for r in got:
        body = bodies[r.conv_id, r.turn]
        ids = [str(c["id"]) for c in body.get("tool_calls", [])]
        ok = sum(next(x[1] for x in calls[r.conv_id, i] if x[0] == r.turn) for i in ids)
        assert (r.n_calls, r.n_valid) == (len(ids), ok)
        a = str(body["tool_call_id"]) if "tool_call_id" in body else None
        hit = first.get((r.conv_id, a))
        levels = [level.get((r.conv_id, i)) for i in ids]
        want = (None if None in levels else max(levels)) if ids else 0
        if a is not None:
            want = level[r.conv_id, a] + 1 if hit and (r.conv_id, a) in level else None
        assert (r.answers, r.linked, r.call_turn, r.level) == (a, hit is not None, hit and hit[0], want)
        seen |= {"breach"} if ok < len(ids) else set()
        seen |= {"valid"} if ok else set()
        seen |= {"missing"} if a and not hit else {"early"} if a and hit[0] > r.turn else {"answered"} if a else set()
        seen |= {"circle"} if ids and want is None else {"waits"} if ids and want else set()
        seen |= {"repeated"} if any(len(calls[r.conv_id, i]) > 1 for i in ids) else set()
    assert seen == {"breach", "valid", "missing", "early", "answered", "circle", "waits", "repeated"}


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
