"""Training-data operators against plain Python, on small tables with the odd cases."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spotweave.llm import exact_dedup, fixity, jaccard_join, mixing, packing, token_files, tokens, topk_search, toxicity, url_filter, wrappers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, hub string, src string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = np.random.default_rng(5)
    vocabulary = ["wort", "Haus", "élan", "tree", "a", "Zug", "x1", "né!", "sky,"] + [f"w{i}" for i in range(60)]
    draw = lambda n: " ".join(rng.choice(vocabulary, n))
    base = draw(90).split()
    out = [None, "", " \n\t", "one", "one two three", "One Two three", "same text here for all of us", "SAME text here for all of us"]
    for i in range(60):  # near copies of one text, some near, some too far
        words = list(base)
        for at in rng.integers(0, 90, i % 7):
            words[at] = f"m{rng.integers(1000)}"
        out.append(" ".join(words))
    out += [draw(int(n)) for n in rng.integers(1, 120, 60)] + [draw(9000), out[10], out[10], "É é", "é É"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", None, 1, "x", "y") for i, t in enumerate(texts())]
    rows += [(None, "one", None, None, None, None, None, None), (3, "one", "en", "s3", 3, 1, "x", "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df):
    return df.toArrow().to_pylist()


def shingles(text):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_exact_groups(docs, none):
    rows = listed(docs.select("doc_id", "text"))
    groups = {}
    for r in rows:
        groups.setdefault((r["text"] or "").translate(UPPER), []).append(r["doc_id"])
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    got = listed(exact_dedup.exact_groups(docs, all_digests=True))
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["full_hash"]) for r in got) == want
    kept = exact_dedup.drop_exact(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in listed(kept)) == Counter(k[0] for k, n in want.items() for _ in range(n) if k[3])
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_exact(none).count() == 0


def test_near_components(docs, none):
    rows = [(r["doc_id"], shingles(r["text"])) for r in listed(docs.select("doc_id", "text"))]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    first = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    want = Counter((doc, len(s), first[root(i)]) for i, (doc, s) in enumerate(rows))
    got = listed(jaccard_join.near_components(docs))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert len({r["component_id"] for r in got}) < len(rows) - 20
    kept = listed(jaccard_join.one_of_each(docs))
    assert Counter(r["doc_id"] for r in kept) == Counter(d for (d, _, c), n in want.items() for _ in range(n) if d == c)
    assert jaccard_join.near_components(none).count() == 0


def test_least_overlap():
    for a in range(1, 40):
        for b in range(1, 40):
            assert jaccard_join.least_overlap(a, b, 75) == next(i for i in range(99) if 100 * i >= 75 * (a + b - i))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(0, 0.2, 16).astype("float32").tolist() for _ in range(300)]
    vectors[7], vectors[8], vectors[9] = None, [float("nan")] * 16, [0.1] * 15 + [None]
    vectors[10], vectors[11], vectors[12:40] = [float("inf")] * 16, [], [vectors[20]] * 28
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)] + [(None, vectors[0], "x")], "vec_id long, embedding array<float>, id string")
    got = listed(topk_search.top_k(df.where("vec_id % 50 = 0"), df))
    valid = {i: v for i, v in enumerate(vectors) if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    whole = {i: np.floor(256 * np.pad(np.array(v, dtype="float64"), (0, 16 - len(v)))).astype(int) for i, v in valid.items()}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == want
    assert topk_search.top_k(df.limit(0), df).count() == 0 and topk_search.top_k(df.where("vec_id = 0"), df.where("vec_id < 3")).count() == 2


def encoded(text, end):
    return tokens.encoder(tokens.TOKENIZER).tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_word_encoder():
    import pyarrow as pa

    odd = ["<|endoftext|> I'M don't a<|startoftext|>b", "é Étude ʼn İstanbul ΑΣ ß \x1c a\x1cb \x85z 中文 a1b2", "'s 't 'LL ...'s!!'re _a_ <b>", "A" * 300 + "é" * 99, "\u0301 e\u0301"]
    every = texts() + odd
    flat = [ids[a:b].tolist() for _, ids, ends in tokens.encoder(tokens.TOKENIZER).encode(pa.array(every)) for a, b in zip([0, *ends], ends)]
    assert flat == [encoded(t, 0)[:-1] for t in every]


@pytest.mark.parametrize("width", [1, 3, 8, 15, 16, 17, 20, 32])
def test_bits(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 70_001).astype("<u4")
    data = token_files.pack(ids, width)
    assert len(data) == -(-len(ids) * width // 8)
    assert (token_files.unpack(data, width, 0, len(ids)) == ids).all() and (token_files.unpack(data, width, 66_001, 99) == ids[66_001:66_100]).all()


def test_token_files(spark, docs, none, tmp_path):
    token_files.write_tokens(docs, f"{tmp_path}/t")
    got = sorted(listed(token_files.read_documents(spark, f"{tmp_path}/t")), key=lambda r: r["start"])
    want = Counter((r["doc_id"], len(i := encoded(r["text"], 2)), crc(i)) for r in listed(docs.select("doc_id", "text")))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)
    read = {r["doc_id"]: r["ids"] for r in listed(token_files.read_ids(spark, f"{tmp_path}/t", [5, 40]))}
    assert read == {5: encoded(texts()[5], 2), 40: encoded(texts()[40], 2)}
    token_files.write_tokens(none, f"{tmp_path}/none")
    assert token_files.read_documents(spark, f"{tmp_path}/none").count() == 0


def test_packing(docs, none):
    got = pd.DataFrame(listed(packing.pack_documents(docs))).sort_values(["sequence_id", "offset"])
    used = got.groupby("sequence_id").length.sum()
    assert used.max() <= 2048 and (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    want = Counter()
    for r in listed(docs.select("doc_id", "text")):
        ids = encoded(r["text"], 1)
        want.update((r["doc_id"], at, min(2048, len(ids) - at), crc(ids[at : at + 2048]), len(ids)) for at in range(0, len(ids), 2048))
    pieces = zip(got.doc_id.astype(object).where(got.doc_id.notna(), None), got.start, got.length, got.ids_crc32, got.doc_tokens)
    assert Counter((None if d is None else int(d), *map(int, rest)) for d, *rest in pieces) == want
    assert len(used) <= used.sum() // 2048 + 2
    assert packing.pack_documents(none).count() == 0


def test_best_fit():
    sizes = sorted(np.random.default_rng(2).integers(1, 65, 400).tolist(), reverse=True)
    places, offsets = packing.best_fit(sizes, 64)
    rooms = []
    for size, place, offset in zip(sizes, places, offsets):
        fits = [room for room in rooms if room >= size]
        if not fits:
            assert place == len(rooms)
            rooms.append(64)
        else:
            assert rooms[place] == min(fits)
        assert offset == 64 - rooms[place]
        rooms[place] -= size


def test_sequences(spark, docs):
    own = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    pieces = packing.pack_documents(own)
    text = {r["doc_id"]: r["text"] for r in listed(own.select("doc_id", "text"))}
    ids = {r["sequence_id"]: r["ids"] for r in listed(packing.sequences(own, pieces))}
    for r in listed(pieces):
        assert ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == encoded(text[r["doc_id"]], 1)[r["start"] : r["start"] + r["length"]]


def test_mixing(docs, none):
    rows = listed(mixing.mix(docs, shard_words=2000))
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in listed(docs.select("doc_id", "text"))}
    source = {r["doc_id"]: r["source"] for r in listed(docs.select("doc_id", "source"))}
    assert all(r["size"] == size[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in rows)
    assert all(len(r["shards"]) == r["copies"] for r in rows) and len({s for r in rows for s in r["shards"]}) > 2
    for own in set(source.values()):
        mine = [r for r in rows if source[r["doc_id"]] == own]
        most = max(r["size"] for r in mine)
        assert mine[0]["source_size"] == sum(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(1, most)
    again = listed(mixing.mix(docs, shard_words=2000))
    key = lambda r: (r["doc_id"] or -1, r["place"])
    assert sorted(rows, key=key) == sorted(again, key=key)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixed_rows_stand_in_the_shards_of_the_mix(spark, docs, tmp_path):
    plan = mixing.mix(docs, shard_words=2000).withColumn("text_size", F.col("size"))
    dealt = plan.select("doc_id", "place", F.posexplode("shards").alias("copy", "shard"))
    want = sorted((r["shard"], r["key"], r["doc_id"]) for r in listed(dealt.select("shard", F.xxhash64("shard", "copy", "place").alias("key"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id"))))
    by_shard = {s: [d for t, _, d in want if t == s] for s in {w[0] for w in want}}
    named = lambda rows: [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    mixing.write_shards(docs, f"{tmp_path}/w", shard_words=2000)
    for shard, ids in by_shard.items():
        assert named(listed(spark.read.parquet(f"{tmp_path}/w/shard={shard}").coalesce(1))) == ids
    assert len(by_shard) > 2
    parts = mixing.mixed(docs, shard_words=2000).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    got = pd.DataFrame(listed(parts.select("doc_id", "part", "at"))).sort_values("at")
    runs = [named(g.astype(object).where(g.notna(), None).to_dict("records")) for _, g in got.groupby("part")]
    flat = [x for run in runs for x in run]
    starts = lambda ids: any(flat[i : i + len(ids)] == ids for i in range(len(flat)))
    assert len(flat) == len(want) and all(starts(ids) for ids in by_shard.values())


def test_targets():
    assert mixing.targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    assert mixing.targets([100, 1, 0], [1, 2, 3]) == [98, 3, 0]
    assert mixing.targets([], []) == [] and mixing.targets([0], [1]) == [0]


def test_split_is_exact():
    counts = np.array([17, 0, 300, 5])
    parts = [mixing.split(counts, 6, shard, 1) for shard in range(6)]
    assert (sum(own for _, own in parts) == counts).all()
    for (before, own), (after, _) in zip(parts, parts[1:]):
        assert (before + own == after).all()


def test_toxicity_on_held_out_rows(spark, none):
    rng = np.random.default_rng(3)
    clean, bad = [f"w{i}" for i in range(300)], ["vile", "Scum", "rotten"]
    rows = []
    for i in range(900):
        words = rng.choice(clean, int(rng.integers(3, 60))).tolist()
        if i % 6 == 0:
            words[0:1] = rng.choice(bad, 2).tolist()
        rows.append((i, " ".join(words) + ".", int(i % 7 > 0), int(i % 6 == 0)))
    rows += [(900, None, 1, 0), (901, "", None, 0), (902, "w1", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int").withColumn("row", F.lit(1))
    labels = df.where("doc_id % 3 < 2").select("doc_id", "quality", "toxic")
    plain = df.drop("quality", "toxic")
    got = {r["doc_id"]: r["toxic"] for r in listed(toxicity.toxic_documents(plain, labels))}
    held = [r for r in rows[:900] if r[0] % 3 == 2]
    assert np.mean([got[r[0]] == bool(r[3]) for r in held]) > 0.99 and not got[900] and not got[901]
    kept = toxicity.without_toxic(plain, labels)
    assert kept.columns == plain.columns and {r["doc_id"] for r in listed(kept)} == {k for k, v in got.items() if not v}
    assert toxicity.toxic_documents(plain, labels.limit(0)).where("toxic").count() == 0
    assert toxicity.toxic_documents(none, labels).count() == 0


def test_words_that_share_low_bits_stay_apart():
    words = toxicity.wordbytes.words(np.frombuffer(" ".join(f"w{i}" for i in range(5000)).encode(), np.uint8), np.array([28889]), toxicity.wordbytes.MARKS)[0]
    low = np.unique(words & np.uint64((1 << 20) - 1), return_counts=True)
    twin = low[0][low[1] > 1][0]
    one, two = (f"w{i}" for i in np.flatnonzero((words & np.uint64((1 << 20) - 1)) == twin)[:2])
    found = [f.tolist() for _, f, _, _ in toxicity.word_features(toxicity.pa.array([one, two, f"{one} {two} {one}"]))][0]
    assert len(set(found)) == 2 and len(found) == 4
    table = pd.DataFrame({"a": [1, 0] * 200, "features": [np.array([found[0], 5]), np.array([4, 5])] * 200})
    link = toxicity.fit_chain(table, ["a"])
    apart = toxicity.probabilities(link, np.array([0, 1]), np.array([found[0], found[1]]), 2)[:, 0]
    assert apart[0] > 0.9 and apart[1] < 0.6


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 400)
    table = pd.DataFrame({"a": first, "b": first, "features": [np.array([1] if f else [2]) for f in first]})
    chain = toxicity.fit_chain(table, ["a", "b"])
    assert len(chain.links[1].before) == 1 and chain.links[1].before[0] > 0


def test_audit_finds_what_brute_force_finds(spark, tmp_path):
    rows = [(i, None if i % 50 == 3 else f"http://h{i % 5}/{i}", None if i % 40 == 7 else f"<p>{i}</p>" * (i % 9), "x") for i in range(700)] + [(None, None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    replica = pages.where("page_id <> 13 OR page_id IS NULL").withColumn("html", F.when(F.col("page_id").isin(0, 350, 699), "<q>").otherwise(F.col("html")))
    ours, theirs = (fixity.in_files(fixity.records(p, per_file=60).select("id", "digest", "size", F.pmod("id", F.lit(9)).alias("file"))) for p in (pages.where("page_id >= 0"), replica.where("page_id >= 0")))
    brute = {(r["file"], r["nth"]): (r["start"], r["size"], r["digest"]) for r in listed(ours)}
    other = {(r["file"], r["nth"]): (r["start"], r["size"], r["digest"]) for r in listed(theirs)}
    want = {k for k in brute.keys() | other.keys() if brute.get(k) != other.get(k)}
    assert {(r["file"], r["nth"]) for r in listed(fixity.audit(ours, theirs))} == want and want
    assert fixity.audit(ours, ours).count() == 0 and fixity.audit(ours.limit(0), ours.limit(0)).count() == 0
    found = listed(fixity.audited(pages, pages))
    assert len(found) == 701 and not any(r["damaged"] for r in found)
    fixity.write_warc(pages, f"{tmp_path}/w")
    read = Counter((r["id"], r["digest"]) for r in listed(fixity.read_warc(spark, f"{tmp_path}/w")))
    assert read == Counter((r["id"], r["digest"]) for r in listed(fixity.records(pages)))


def test_audited_with_all_kinds_of_damage(spark):
    rows = [(i, f"http://h{i % 5}/{i}", f"<p>{i}</p>" * (1 + i % 9)) for i in range(2001)] + [(None, None, None), (7, "http://h/", "again"), (7, "http://h/", "again")]
    schema = "page_id long, url string, html string"
    other = [(i, u, {3: "<q>3</p>", 50: "<p>", 51: "<p>51</p>" * 20}.get(i, h)) for i, u, h in rows if i not in (0, 1999)]
    other = [r for r in other if r != (7, "http://h2/7", "<p>7</p>" * 8)] + [(7, "http://h2/7", "~"), (-4, "http://new/", "x"), (9000, None, None)]
    got = listed(fixity.audited(spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)))
    found = sorted((r["page_id"], r["state"]) for r in got if r["damaged"])
    assert found == [(-4, "extra"), (0, "missing"), (3, "changed"), (7, "changed"), (50, "changed"), (51, "changed"), (1999, "missing"), (9000, "extra")]
    assert len(got) == len(rows) + 2 and all(r["state"] == "intact" for r in got if not r["damaged"])
    assert len({(r["file"], r["nth"]) for r in got}) == len(got) and {r["file"] for r in got} == {0, 1, 2}
    none = spark.createDataFrame([], schema)
    assert {r["state"] for r in listed(fixity.audited(none, spark.createDataFrame(rows, schema)))} == {"extra"}
    assert {r["state"] for r in listed(fixity.audited(spark.createDataFrame(rows, schema), none))} == {"missing"}


def page(title, body, extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><script>var t='</p>';</script></head><body><header>Site</header><nav><ul><li><a href='/'>{title} menu</a></li></ul></nav>"
        f"<div class='cookie-notice'>We use cookies</div><article><h1>{title}</h1>{body}<div class='share'>Share</div></article><aside>More {title}</aside>"
        f"<section id=comments><p>I disagree</p></section><form><label>Mail</label></form>{extra}<footer>&copy; us</footer></body></html>"
    )


def test_main_text(spark):
    body = "<p>A &amp; b\n  c <b>bold</b><br>next <!-- no --> &lt;x&gt;<p>open <span class=ad>buy</span> end<style>p{}</style></p><ul><li>one<li>two</ul>"
    plain = "<html><body><div class=menu>Menu</div><div class=top>Always here</div><div class=body><p>Story {0}</p></div><div class=links><a href=x>l{0}</a></div></body></html>"
    rows = [(i, f"http://a.b/{i}", page(f"T{i}", body), "x") for i in range(4)]
    rows += [(10 + i, f"http://c.d/{i}", plain.format(i), "x") for i in range(4)]
    rows += [(20, None, None, "x"), (21, "no host", "", "x"), (22, "http://e.f/", "just text & more", "x"), (22, "http://e.f/", "just text & more", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in listed(wrappers.main_text(df))}
    want = "A & b c bold next <x>\nopen end\none\ntwo"
    for i in range(4):
        assert got[i][0] == f"T{i}\n{want}" and got[i][1] == len(got[i][0])
        assert got[10 + i][0] == f"Story {i}"
    assert got[20] == ("", 0) and got[21] == ("", 0) and got[22][0].startswith("just text & more")
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_constant_siblings_are_template(spark):
    html = "<body><div><p>Copyright</p><p>Terms</p></div><ul><li>One</li><li>Two</li></ul><div class=body><p>Story {0}</p><p>Read more soon</p><p>End {0}</p></div></body>"
    rows = [(i, f"http://c.d/{i}", html.format(i)) for i in range(5)] + [(9, "http://x.y/", html.format(9))]
    got = {r["page_id"]: r["text"] for r in listed(wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert [got[i] for i in range(5)] == [f"Story {i}\nEnd {i}" for i in range(5)]
    assert got[9].startswith("Copyright\nTerms\nOne")  # one page says nothing about its host


def test_marks_do_not_replace_the_slots(spark):
    cards = "<body><div class=text><p>Long story number {0}</p></div><div><article><p>Card {0}</p></article></div></body>"
    above = "<body><main><h1>Title {0}</h1><article><p>A story of {0} and what came of it</p><div><p>Read on soon</p></div></article></main></body>"
    rows = [(i, f"http://c.d/{i}", cards.format(i)) for i in range(5)] + [(10 + i, f"http://x.y/{i}", above.format(i)) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in listed(wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    for i in range(5):
        assert got[i] == f"Long story number {i}\nCard {i}"
        assert got[10 + i] == f"Title {i}\nA story of {i} and what came of it"


def test_names_do_not_drop_articles(spark):
    kinds = ["<article class='post has-comments'>{0}</article>", "<article class='hentry category-legal comments'>{0}</article>", "<div id=content class='with-sidebar'>{0}</div>"]
    kinds += ["<div class='legal notice'><p>{0}</p></div><div class='ad-slot'>Buy {1}</div>"]
    rows = [(10 * k + i, f"http://h{k}/{i}", html.format(f"<p>A long story of {i}</p>", i)) for k, html in enumerate(kinds) for i in range(4)]
    rows += [(90, "http://one/", "<article>a</article><div class=ad>Buy what you never wanted</div><div class='site-footer'>us</div>")]
    got = {r["page_id"]: r["text"] for r in listed(wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert all(got[10 * k + i] == f"A long story of {i}" for k in range(4) for i in range(4)) and got[90] == "a"


def test_align_keeps_order():
    tree = lambda *labels: [[-1, "html"], *[[0, x] for x in labels]]
    assert wrappers.align(tree("a", "b", "c"), tree("a", "x", "c")) == {0: 0, 1: 1, 3: 3}
    assert wrappers.align(tree("a"), [[-1, "other"]]) == {}


def test_url_rules_and_trees(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    hosts = ["a.example.org", "EXAMPLE.org", "badexample.org", "x.com", "com", "m.casino-win.net", "ok.net", "blog.fine.net", "free-bets.net"]
    paths = ["/es/1", "/en/1?a=/es/", "/en/2#x", "/fr/", "/de/9?q://z", "", "?x", "/a/b"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] * 3 + [None, "", "no host", "://", "a\n://H.com/de/"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in listed(url_filter.judge(df))}
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split(r"[/?#]", rest)[0]
            path, host = re.split(r"[?#]", rest[len(host) :])[0], host.translate(UPPER)
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, max(fits)[2] if fits else None)
        unwanted = "casino" in host or "bets" in host
        assert got[i]["verdict"] == (max(fits)[1] if fits else "block" if unwanted else "allow")
    assert url_filter.judge(df.limit(0)).count() == 0


def test_suffix_rates_leave_out_the_own_fold(spark):
    own = [f"d{i}.com" for i in range(6000)]
    rows = [(h, int(k % 2 == 0)) for k, h in enumerate(own)] + [("big.net", 1)] * 500 + [("new.org", None)]
    table = [(f"http://a.{h}/{k}", f"a.{h}", h, y) for k, (h, y) in enumerate(rows)]
    df = spark.createDataFrame(table, "url string, host string, suffix string, label int")
    got = {}
    for r in listed(url_filter.with_suffix(df)):
        got.setdefault(r["suffix"], []).append(r)
    assert got.keys() == set(own) | {"big.net", "new.org"}
    assert all(got[h][0]["count"] == 1 and got[h][0]["rate"] == -1 for h in own)  # its only label is its own
    assert got["big.net"][0]["count"] == 500 and len({r["rate"] for r in got["big.net"]}) == url_filter.FOLDS and got["new.org"][0]["rate"] == -1
    assert all(0.9 < r["rate"] < 1 for r in got["big.net"])


def test_partial_labels_do_not_block_unlabelled_domains(spark):
    rng = np.random.default_rng(6)
    rows = [(i, f"https://www.d{rng.integers(10**9)}.com/p/{i}", int(rng.integers(2)) if i % 2 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, y int")
    got = [r["verdict"] for r in listed(url_filter.judge(df, label=F.col("y"))) if r["page_id"] % 2 == 0]
    assert 0.1 < sum(v == "block" for v in got) / len(got) < 0.9


def test_boosting_learns_held_out_rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = url_filter.boost(x[:2000], y[:2000])
    assert ((trees.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_large_ids_beside_null_ones(spark):
    ids = [None, 9007199254740993, 9007199254740995, -9007199254740993]
    df = spark.createDataFrame([(i, "a text " * 3000) for i in ids], "doc_id long, text string")
    assert {r["doc_id"] for r in listed(packing.pack_documents(df))} == set(ids)


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 4000 + "<p>Deep inside.</p>" + "</div>" * 4000
    names = [a + b + c for a in "bcdfghjklm" for b in "bcdfghjklm" for c in "bcdfghjklmnpqrstvwxzaeiouy"]
    wide = "".join(f"<p class={c}>Word {c}.</p>" for c in names)
    rows = [(i, f"http://a{i}.com/x", h) for i, h in enumerate([deep, wide, f"<article>{wide}</article>", deep.replace("Deep", "Far")])]
    got = {r["page_id"]: r["text"] for r in listed(wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert got[0] == "Deep inside." and got[2].count("\n") == len(names) - 1


def test_aligned_trees_keep_the_order_of_siblings():
    rng = np.random.default_rng(7)
    for _ in range(200):
        places = rng.permutation(int(rng.integers(1, 8))).tolist()
        weights = rng.integers(1, 4, len(places)).tolist()
        run = wrappers.heaviest_increasing(places, weights)
        best = max(sum(weights[i] for i in s) for s in ([i for i in range(len(places)) if m >> i & 1] for m in range(1, 2 ** len(places))) if all(places[a] < places[b] for a, b in zip(s, s[1:])))
        assert [places[i] for i in run] == sorted(places[i] for i in run) and sum(weights[i] for i in run) == best


def test_repeated_headings_of_articles_stay(spark):
    page = "<nav>Home</nav><article><h2>Daily weather</h2><p>Rain in town {0}.</p><h3>Forecast</h3><p>Sun on day {0}.</p></article>"
    df = spark.createDataFrame([(i, "http://w.com/a", page.format(i)) for i in range(4)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in listed(wrappers.main_text(df))}
    assert got == {i: f"Daily weather\nRain in town {i}.\nForecast\nSun on day {i}." for i in range(4)}
