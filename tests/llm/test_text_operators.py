from __future__ import annotations

import random
import re
import tracemalloc

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harrow.llm import chunk_dedup, decontaminate, html_main, language, line_dedup, toxicity
from harrow.llm.oracles import LINE_DEDUP, SEED_OVERLAPS


def by_duckdb(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas())
    return con.sql(sql).df()


def same(got, expected):
    columns = sorted(expected.columns)
    order = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got.toPandas()), order(expected), check_dtype=False)


# ------------------------------------------------------------------ lines


def line_corpus():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(300)}"
    pool = [" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(60)]
    texts = []
    for _ in range(70):
        lines = []
        for _ in range(rng.randint(1, 8)):
            line = rng.choice(pool).split()
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = word()
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    return texts + ["", "\n\n", "A b\tc  d\r\na B C D", "same " * 3000, "\n".join(["hot line here"] * 300), texts[0]]


def test_lines_against_sql(spark, store):
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(line_corpus())], "doc_id long, text string, h string, kept int")
    got = line_dedup.dedup_lines(df, store)
    assert got.columns == ["doc_id", "text", "h", "kept", "n_lines", "n_removed"]
    same(got.select("doc_id", "text", "n_lines", "n_removed"), by_duckdb(LINE_DEDUP, documents=df.select("doc_id", "text")))


def test_plans_of_line_classes_are_short(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(20_000)),)], "text string")
    column = line_dedup.rarity_classes(docs)
    assert len(docs.select(column)._jdf.queryExecution().optimizedPlan().toString()) < 150_000


def test_line_edge_cases(spark, store):
    rows = [(1, "a b c d e"), (None, "a b c d e"), (2, None), (3, "a b c d e\n\nnew"), (1, "a b c d e"), (None, None)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), store)
    out = sorted((repr(r["doc_id"]), repr(r["text"]), r["n_lines"], r["n_removed"]) for r in got.collect())
    assert out == sorted([("1", "'a b c d e'", 1, 0), ("1", "'a b c d e'", 1, 0), ("2", "None", 0, 0), ("3", repr("\nnew"), 3, 1), ("None", "'a b c d e'", 1, 0), ("None", "None", 0, 0)])
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string"), store).count() == 0


def slow_lines(spark, rows, threshold=0.8):
    """What stays of each row by the definition: lines in order of (id, place, hash of the text)."""
    hashes = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for _, t in rows], "text string").selectExpr("text", "xxhash64(text) AS h").collect()}
    lines = sorted({(d, k, hashes[t], line) for d, t in rows for k, line in enumerate(t.split("\n"))})
    words = [frozenset(line.lower().split()) for *_, line in lines]
    gone = set()
    for i, (d, k, h, _) in enumerate(lines):
        if words[i] and any(words[j] and len(words[i] & words[j]) >= threshold * len(words[i] | words[j]) - 1e-9 for j in range(i)):
            gone.add((d, k, h))
    return sorted((d, "\n".join(line for k, line in enumerate(t.split("\n")) if (d, k, hashes[t]) not in gone)) for d, t in rows)


@pytest.mark.parametrize("seed", range(3))
def test_lines_of_repeated_ids_against_brute_force(spark, store, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        words = [f"i{i}w{k}" for k in range(11)]
        for _ in range(rng.randint(2, 3)):  # each pair has a similarity of 10 in 12 or less
            own = list(words)
            own[rng.randrange(11)] = f"x{rng.randrange(10**6)}"
            rows.append((i // rng.choice([1, 2]), "\n".join([f"only{rng.randrange(10**6)}"] * rng.randint(0, 1) + [" ".join(own)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(df, store).collect())
    assert got == slow_lines(spark, rows) and got != sorted(rows)


def near_copies(base, copies):
    """Lines of one text each: of every base of 20 words the line itself and copies with one word of their own at the end."""
    return [" ".join([f"b{b}w{k}" for k in range(20)] + [f"own{b}x{c}"] * (c > 0)) for b in range(base) for c in range(copies)]


def test_line_entries_are_shuffled_once(spark, store):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(near_copies(20, 3))], "doc_id long, text string, h long")
    classes = line_dedup.line_classes(docs, store, 0.8).withColumn("open", F.lit(True))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = line_dedup.open_pairs(classes, 0.8)
        assert pairs.count() == len(pairs.collect()) == 20 * 3
        assert "ReusedExchange" in pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("crowd", [0, 32])
def test_crowded_lines(spark, store, monkeypatch, crowd):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    lines = near_copies(5, 3) + near_copies(6, 60)[5 * 60 :]
    rows = list(enumerate(lines))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = line_dedup.line_classes(df.withColumn("h", F.xxhash64("text")), store, 0.8)
    first = line_dedup.first_pairs(classes, line_dedup.crowded_keys(classes, store, crowd), 0.8)
    later = {r["id"] for r in classes.where("doc_id >= 15").select("id").collect()}
    found = {r["later"] for r in first.collect()}
    assert len(found & later) > 40 and bool(found - later) == (crowd == 0)  # few copies of a line are left to the join of all
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(df, store).collect())
    assert got == slow_lines(spark, rows) and sum(t != "" for _, t in got) == 6


# ------------------------------------------------------------------ benchmark


def test_overlaps_against_sql(spark, store):
    rng = random.Random(2)
    word = lambda: f"t{rng.randrange(400)}"
    items = [[word() for _ in range(n)] for n in (4, 5, 6, 9, 10, 20, 30, 55)]
    docs = []
    for k in range(80):
        text = [word() for _ in range(rng.randint(0, 60))]
        if k % 2:
            part = list(rng.choice(items))
            for _ in range(k % 9):
                part[rng.randrange(len(part))] = word()
            text[rng.randint(0, len(text)) :] = part
        docs.append(" ".join(text).replace(" ", rng.choice([" ", ", ", "\n"])).upper() if k % 3 else " ".join(text))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = decontaminate.contaminated(df, bench, store, short_items=True)
    assert got.count() > 10
    same(got, by_duckdb(SEED_OVERLAPS, documents=df, benchmark=bench))


def test_overlap_edge_cases(spark, store):
    item = " ".join(f"x{i}" for i in range(30))
    rows = [(1, f"before {item} after"), (1, f"before {item} after"), (2, None), (None, item), (3, ""), (4, "long " * 20000 + item)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (None, item), (9, "a b")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["similarity"], r["start"], r["length"]) for r in decontaminate.contaminated(df, bench, store).collect())
    assert got == [(1, 7, 1.0, 1, 20), (4, 7, 1.0, 20000, 20)]
    assert sorted(repr(r["doc_id"]) for r in decontaminate.clean(df, bench, store).collect()) == ["2", "3", "None"]
    assert decontaminate.contaminated(df.limit(0), bench, store).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0), store).count() == 0


def test_substitutions_are_tolerated(spark, store):
    words = [f"x{i}" for i in range(25)]
    changed = [w if i % 6 else "other" for i, w in enumerate(words)]
    df = spark.createDataFrame([(1, " ".join(changed)), (2, " ".join(w if i % 3 else "other" for i, w in enumerate(words)))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.contaminated(df, bench, store).collect()] == [1]


def test_short_items_with_any_substitution(spark, store):
    """Each item of 5 to 9 words with one substitution at each place, against all line-ups; two substitutions are too many."""
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(5, 10)}
    docs, expected = [], set()
    for n, words in items.items():
        for k in range(n):
            one = [w if i != k else "other" for i, w in enumerate(words)]
            expected.add((len(docs), n))
            docs.append(["before", *one, "after"])
            docs.append([w if i != (k + 2) % n else "more" for i, w in enumerate(one)])
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench, store, short_items=True).collect()}
    assert got == expected


# ------------------------------------------------------------------ chunks


def test_gear_hash_byte_by_byte():
    rng = random.Random(9)
    for n in (0, 1, 40, 3000):
        data = "".join(rng.choice("ab cdé\n") for _ in range(n)).encode()
        ends, last, h = [], 0, 0
        for i, byte in enumerate(data):
            h = ((h << 1) + int(chunk_dedup.GEAR[byte])) % 2**32
            border = i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80
            size = i + 1 - last
            if border and (size >= 16 and h >> 27 == 0 and size <= 256 or size >= 256):
                ends.append(i + 1)
                last = i + 1
        if last < len(data):
            ends.append(len(data))
        assert chunk_dedup.cut_points(data) == ends


def test_repeats_within_one_document(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage = prose(60)
    text = f"{prose(30)} {passage} {prose(30)} {passage} {prose(20)}"
    df = spark.createDataFrame([(1, text), (1, text), (2, prose(50))], "doc_id long, text string")
    assert chunk_dedup.remove_repeats(df).where("doc_id = 1").first()["text"] == text
    kept = chunk_dedup.remove_repeats(df, within=True)
    cut = kept.where("doc_id = 1").first()["text"]
    assert passage in cut and len(text) - len(passage) - 5 <= len(cut) < len(text) - len(passage) // 2 and kept.count() == 3


def test_chunks_resist_insertions():
    rng = random.Random(1)
    text = " ".join(f"é{rng.randrange(10**6)}" for _ in range(400))

    def cuts(t):
        ends = chunk_dedup.cut_points(t.encode())
        return [t.encode()[a:b] for a, b in zip([0, *ends], ends)]

    one, two = cuts(text), cuts("inserted " + text)
    assert b"".join(one) == text.encode() and all(c.decode() for c in one)
    assert len(set(one) & set(two)) > 0.9 * len(one)
    assert chunk_dedup.cut_points(b"") == [] and all(len(c) <= 260 for c in cuts("x" * 5000))


def slow_passages(rows, least):
    """Passages by dictionaries over the same chunks."""
    chunks = {}
    for d, t in set(rows):
        data = t.encode()
        ends = chunk_dedup.cut_points(data)
        chunks[d] = [(s, e, data[s:e]) for s, e in zip([0, *ends], ends)]
    held = {}
    for d, cs in chunks.items():
        for _, _, c in cs:
            held.setdefault(c, set()).add(d)
    out = []
    for d, cs in chunks.items():
        run = []
        for c in [*cs, (None, None, None)]:
            if c[2] is not None and len(held[c[2]]) > 1:
                run.append(c)
                continue
            if run and run[-1][1] - run[0][0] >= least:
                out.append((d, run[0][0], run[-1][1] - run[0][0], len(run), sum(min(held[x[2]]) < d for x in run)))
            run = []
    return sorted(out)


def test_passages_of_one_document_are_reported(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage, shared = prose(80), prose(80)
    rows = [(1, f"{prose(30)} {passage} {prose(30)} {passage} {prose(20)}"), (2, f"{shared} {prose(60)}"), (3, f"{prose(40)} {shared}"), (4, prose(200))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    got = [(r["doc_id"], r["n_duplicate"] > 0, texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["length"]].decode()) for r in chunk_dedup.repeated_passages(df, within=True).collect()]
    assert sorted((d, dup) for d, dup, _ in got) == [(1, False), (1, True), (2, False), (3, True)]
    assert all(t in (passage if d == 1 else shared) and len(t) > 200 for d, _, t in got)
    assert {r["doc_id"] for r in chunk_dedup.repeated_passages(df).collect()} == {2, 3}


def test_passages_against_brute_force(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passages = [prose(60) for _ in range(4)]
    texts = [prose(rng.randint(0, 80)) + rng.choice(["", *passages]) + prose(30) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[3]), (101, ""), (102, "short"), (103, "short"), (104, "z" * 30000), (4, texts[4])]
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(None, texts[0], 1), (105, None, 1)], "doc_id long, text string, start int")
    got = chunk_dedup.repeated_passages(df)
    assert sorted((r["doc_id"], r["start"], r["length"], r["n_chunks"], r["n_duplicate"]) for r in got.collect()) == slow_passages([r for r in rows if r[1]], 96)
    found = {r["doc_id"] for r in got.collect()}
    assert {i for i, t in enumerate(texts) if any(p in t for p in passages)} <= found
    kept = {r["doc_id"]: r["text"] for r in chunk_dedup.remove_repeats(df.select("doc_id", "text")).collect()}
    assert kept[3] == texts[3] and kept[100] == "" and kept[105] is None and kept[102] == "short" and len(kept) == len(set(r[0] for r in rows)) + 2
    assert chunk_dedup.repeated_passages(df.limit(0)).count() == 0


# ------------------------------------------------------------------ pages


def test_declared_article():
    page = """<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy.</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>One.<br><p>Two  &eacute;&nbsp;x</p><form>Sign</form><p>Be.</p><div class="share-buttons">Share</div><aside>side</aside></article>
    <section class="comments"><p>%s</p></section><footer>&copy; end</footer>""" % ("Reader says so. " * 30)
    assert html_main.main_text(page) == "Head & line One. Two é x Be."


def test_undeclared_article():
    body = "".join(f"<p>{'Prose words go on. ' * 8}{i}</p>" for i in range(5))
    menu = "".join(f"<li><a href='/{i}'>Topic {i}</a></li>" for i in range(8))
    page = f"<body><div><ul>{menu}</ul></div><h1>Title here</h1>{body}<div id='cookie-notice'>We use cookies {'again ' * 40}</div><div><ul>{menu}</ul></div></body>"
    text = html_main.main_text(page)
    assert text.startswith("Title here Prose") and text.endswith("4") and "Topic" not in text and "cookies" not in text


@pytest.mark.parametrize(("page", "text"), [(None, ""), ("", ""), ("<p>tiny</p>", "tiny"), ("<article>x &am", "x &am"), ("<article><p>a<p>b</article>", "a b"), ("<article hidden><p>x</p></article>", ""), ("<article><script>if (a<b) x</script>y", "y"), ("<article>1 < 2 <3> <b>x</b>y", "1 < 2 <3> xy")])
def test_odd_pages(page, text):
    assert html_main.main_text(page) == text


def test_undeclared_text_between_surge_and_dive():
    prose = "".join(f"<p>{'Prose words go on. ' * 8}{i}</p>" for i in range(2))
    linked = "<p><a href='/x'>A paragraph that is one link</a> or nearly</p>"
    advert = "<div class='ad'><p>Buy this</p><p>and that</p><p>right now</p></div>"
    text = html_main.main_text(f"<body>{prose}{linked}{prose}{advert}<p>The short end.</p></body>")
    assert "one link or nearly Prose" in text and text.endswith("The short end.") and "Buy" not in text


def test_small_article_beside_the_main_text():
    prose = "".join(f"<p>{'Prose words go on. ' * 8}{i}</p>" for i in range(4))
    text = html_main.main_text(f"<body><div>{prose}</div><ul><li><a href='/1'>One</a><li><a href='/2'>Two</a><li><a href='/3'>Three</a></ul><article><p>Teaser of another page.</p></article></body>")
    assert text.count("Prose") == 32 and "Two" not in text


def test_windows_decide_beside_a_declared_article():
    """A long paragraph outside the declared article is text, a short one isn't, and a name with a listed word in its middle tells nothing."""
    prose = "".join(f"<p>{'Prose words go on. ' * 30}{i}</p>" for i in range(4))
    long, short = f"<div><p>{'An opening. ' * 90}</p></div>", "<div><p>A short line outside.</p></div>"
    text = html_main.main_text(f"<body>{short}{long}<article>{prose}<p>Be.</p><div class='post-form-note'>A note.</div></article>{short}{short}</body>")
    assert text.startswith("An opening.") and text.endswith("3 Be. A note.") and "outside" not in text


def slow_text(lines, window, threshold):
    """The definition, line by line: a kept line lies between a surge and the first window after it that weighs nothing."""
    weights = html_main.line_weights(lines, threshold)
    block = [sum(weights[i : i + window]) for i in range(len(lines))]
    need = min(threshold, max(1, sum(w for w in weights if w > 0) // 2))
    kept = []
    for i in range(len(lines)):
        surges = [s for s in range(i + 1) if weights[s] > 0 and block[s] >= need and all(block[k] > 0 for k in range(s, i + 1))]
        if surges and weights[i] >= 0:
            kept.append(lines[i][0])
    return " ".join(kept)


def test_main_text_against_brute_force():
    rng = random.Random(4)
    for k in range(300):
        blocks = []
        for _ in range(rng.randint(0, 12)):
            words = " ".join("word" * rng.randint(1, 2) for _ in range(rng.choice([1, 3, 10, 60, 200])))
            blocks.append(f"<p><a href='/'>{words}</a></p>" if rng.random() < 0.3 else f"<p>{words}</p>" if rng.random() < 0.8 else f"<nav>{words}</nav>")
        cut = rng.randint(0, len(blocks))
        page = "".join(blocks[:cut]) + ("<article>" if k % 2 else "<div>") + "".join(blocks[cut:])
        assert html_main.main_text(page) == slow_text([x for x in html_main.page_lines(page) if not x[2]], 3, 80)


def test_short_and_empty_pages(spark):
    assert html_main.main_text("<body><p>A short story of one line.</p></body>") == "A short story of one line."
    assert html_main.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_extract(spark):
    df = spark.createDataFrame([(1, "u", "<article>é</article>", 0), (1, None, None, 0), (None, "v", "<article>" + "w " * 30000 + "</article>", 0)], "page_id long, url string, html string, text int")
    got = {(r["page_id"], r["url"]): (r["text"][:3], r["n_chars"]) for r in html_main.extract(df).collect()}
    assert got == {(1, "u"): ("é", 1), (1, None): ("", 0), (None, "v"): ("w w", 59999)}


# ------------------------------------------------------------------ toxicity


def labelled(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(300)}x" for _ in range(rng.randint(5, 60))]
        words = [re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], w) for w in words]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), f"zorg{rng.choice('abcdefg')}{rng.choice('hijk')}")
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), int(toxic)))
    return rows


def test_toxicity_learns_and_calibrates(spark):
    rows = labelled(1200)
    docs = spark.createDataFrame([r[:3] for r in rows] + [(5000, None, None), (5001, "", "xx"), (None, "zorgah zorgbi", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.Settings(train_rows=200, calibrate_rows=60))
    assert set(model.thresholds) <= {"en", "de"} and all(0.25 <= t <= 0.75 for t in model.thresholds.values())
    scored = {r["doc_id"]: r for r in toxicity.score(docs.withColumn("score", __import__("pyspark").sql.functions.lit("x")), model).collect()}
    truth = {r[0]: r[3] for r in rows}
    held = [d for d in truth if __import__("zlib").crc32(str(d).encode()) % 5 == 0]
    right = np.mean([(scored[d]["score"] >= 0.5) == bool(truth[d]) for d in held])
    assert right > 0.95 and len(scored) == 1203
    assert 0 <= scored[5000]["score"] <= 1 and scored[5000]["score"] == scored[5001]["score"] and scored[None]["rejected"]


def test_scores_against_plain_loops():
    """Every window of every filter over every word, one by one."""
    rows = labelled(120)
    model = toxicity.train([r[1] for r in rows], np.array([r[3] for r in rows]), toxicity.Settings(epochs=1, least_steps=5))
    s, texts = model.settings, [None, "", "one", "zorgah zorgbi x", *[r[1] for r in rows[:10]]]
    expected = []
    for text in texts:
        words = [model.embed[toxicity._features([w], s.buckets)[0]].sum(axis=0) for w in toxicity.split_words(text)]
        words += [np.zeros(s.dim)] * max(s.widths)
        z, k = model.out_bias + model.shift, 0
        for width, filters in zip(s.widths, model.filters):
            for f in range(s.filters):
                best = max(sum(float(words[i + j] @ filters[j * s.dim : (j + 1) * s.dim, f]) for j in range(width)) for i in range(len(words) - width + 1))
                z += max(best + model.bias[k], 0) * model.out[k]
                k += 1
        expected.append(1 / (1 + np.exp(-z)))
    assert np.allclose(toxicity.score_texts(model, texts), expected, atol=1e-4)


def test_training_keeps_no_word_twice():
    rng = random.Random(5)
    words = [f"w{''.join(rng.choices('abcdefgh', k=7))}" for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(600)]
    labels = np.arange(600) % 2
    tracemalloc.start()
    try:
        model = toxicity.train(texts, labels, toxicity.Settings(epochs=1, least_steps=1))
        learned = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        toxicity.calibrate(model, texts, labels, [None] * 600)
        calibrated = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # with strings for all 240,000 words, and all texts scored at once, 25 and 40 MB
    assert learned < 14e6 and calibrated < 14e6, (learned, calibrated)


def test_rows_that_repeat_a_sampled_id(spark):
    rows = labelled(60)
    docs = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows] + [(2, "word " * 50000, "en")] * 3, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    one, two = (toxicity.fit(d, labels, toxicity.Settings(epochs=1, least_steps=2)) for d in (docs, docs.orderBy(F.desc("doc_id"))))
    assert np.array_equal(one.out, two.out) and one.thresholds == two.thresholds


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, model).first()["score"] == 0.5
    assert toxicity.score(docs.drop("lang").limit(0), model).count() == 0


# ------------------------------------------------------------------ language


def test_language(spark, store):
    texts = {"en": "the quick brown fox and the dog with those things that they have", "de": "der schnelle braune fuchs und die hunde mit ihren sachen nicht wahr", "fr": "le renard brun et les chiens avec leurs choses qui sont ici"}
    docs = spark.createDataFrame([(t * 5, lang) for lang, t in texts.items()] + [(None, "en"), ("x", None)], "text string, lang string")
    rows = [(i, f"http://{lang}.example.{lang}/{i}", f'<html lang="{lang}"><body><article>{" ".join(random.Random(i).sample(t.split(), 6))}</article>') for i, (lang, t) in enumerate(list(texts.items()) * 8)]
    rows += [(100, "http://de.example.de/x", None), (101, None, None), (102, "http://fr.example.fr/", "<html lang='en'><article>le renard brun et les chiens avec leurs choses</article>"), (103, "junk", "<html lang=de>")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, lang int")
    got = {r["page_id"]: r for r in language.identify(df, docs, store).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang"] == ["en", "de", "fr"][i % 3] for i in range(24))
    assert got[100]["lang"] == "de" and got[102]["lang"] == "fr" and got[103]["lang"] == "de" and got[101]["lang"] in texts and got[101]["host"] is None
    assert all(0 < r["probability"] <= 1 for r in got.values()) and got[0]["host_pages"] == 8
    assert language.identify(df.limit(0), docs, store).count() == 0
    assert {r["lang"] for r in language.identify(df, docs.limit(0), store).collect()} == {None}


def test_a_page_does_not_judge_itself(spark, store):
    """Against the same formulas over dictionaries, each page's own posterior taken out of the sums."""
    rng = random.Random(8)
    texts = {"en": "the quick brown fox and the dog with those things that they have".split(), "de": "der schnelle braune fuchs und die hunde mit ihren sachen nicht wahr".split()}
    docs = spark.createDataFrame([(" ".join(t * 5), lang) for lang, t in texts.items()], "text string, lang string")
    rows = []
    for i in range(60):
        words = rng.sample(texts["en"] + texts["de"], rng.randint(0, 4))
        host = rng.choice([f"http://{rng.choice('ab')}.{rng.choice('xy')}.{rng.choice(['com', 'de'])}/", None])
        rows.append((i, host, f"<html lang={rng.choice(['en', 'de'])}><p>{' '.join(words)}" if i % 5 else f"<p>{' '.join(words)}"))
    rows += [rows[3], (60, "http://alone.zz/", "<html lang=de><p>" + "der schnelle fuchs " * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    settings = language.Settings()
    langs, table = language.trigram_model(docs, settings)
    scored = [(r["page_id"], r["url"], r["declared"], np.array(r["ll"])) for r in language.text_likelihoods(df, langs, table, settings).collect()]
    soft = [np.exp(ll - ll.max()) / np.exp(ll - ll.max()).sum() for *_, ll in scored]
    key = {"host": lambda u: u and u[7:-1], "domain": lambda u: u and ".".join(u[7:-1].split(".")[-2:]), "suffix": lambda u: u and u[7:-1].split(".")[-1]}
    total = lambda hit, skip: sum((p for j, p in enumerate(soft) if j != skip and hit(scored[j])), np.zeros(len(langs)))
    expected = []
    for j, (page, url, declared, ll) in enumerate(scored):
        prior = (total(lambda r: True, j) + 1) / (len(scored) + len(langs))
        for level in ("suffix", "domain", "host"):
            if url:
                sums = total(lambda r: r[1] and key[level](r[1]) == key[level](url), j)
                prior = (sums + settings.smooth * prior) / (sums.sum() + settings.smooth)
        post = ll + np.log(prior)
        for known, value, of in ((declared, declared, lambda r: r[2]), (url, key["suffix"](url), lambda r: key["suffix"](r[1]))):
            if known:
                n = len({of(r) for r in scored if of(r)})
                rest = total(lambda r: of(r), j)
                post = post + np.log((1 - settings.trust) * (total(lambda r: of(r) == value, j) + 0.1) / (rest + 0.1 * n) + settings.trust / n)
        expected.append((page, langs[int(post.argmax())], round(float(1 / np.exp(post - post.max()).sum()), 6)))
    got = [(r["page_id"], r["lang"], round(r["probability"], 6)) for r in language.identify(df, docs, store).collect()]
    assert sorted(got) == sorted(expected)


def test_language_of_rare_declarations_and_suffixes(spark, store):
    docs = spark.createDataFrame([("the quick brown fox " * 9, "en"), ("der schnelle braune fuchs " * 9, "de")], "text string, lang string")
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(600):  # more values than 500, the rarest one of them German
        tag = letters[k // 26] + "x" + letters[k % 26]
        rows += [(len(rows) + i, f"http://h{k}x{i}.{tag}/", f"<html lang={tag}><p>the quick brown fox") for i in range(4)]
    rows += [(10_000 + i, f"http://z{i}.zzz/", "<html lang=zzz><p>der schnelle braune fuchs") for i in range(2)]
    rows += [(20_000, "http://new.zzz/", "<html><p>"), (20_001, None, "<html lang=zzz><p>"), (20_002, None, "<html><p>")]
    got = {r["page_id"]: r for r in language.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs, store).collect()}
    assert len(got) == len(rows)
    assert got[20_000]["lang"] == "de" and got[20_002]["lang"] == "en"
    assert got[20_001]["probability"] < 0.99 < got[20_002]["probability"], (got[20_001], got[20_002])  # English is commoner by far
