import random
import re

from candlewick.llm import decontaminate as D


def norm(text):
    return " ".join(re.sub(r"[\W_]+", " ", text.lower()).split())


def held(window, text, budget):
    """Whether some region of the text is within the budget of the window: plain semi-global edit distance."""
    row = list(range(len(window) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, w in enumerate(window, 1):
            new.append(min(row[i - 1] + (c != w), row[i] + 1, new[i - 1] + 1))
        row, best = new, min(best, new[-1])
    return best <= budget


def windows(text, size, step):
    t = norm(text)
    starts = sorted({*range(0, max(1, len(t) - size), step), max(0, len(t) - size)})
    return [t[s:s + size] for s in starts] if len(t) >= D.SHORTEST else []


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        out[k] = rng.choice(["", "q", out[k] + "z", out[k]])
    return "".join(out)


def test_against_plain_edit_distance(spark):
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(n))
    items = [(k, say(14)) for k in range(8)] + [(8, say(5)), (9, "abc"), (10, None), (11, ""), (12, "Same, here: " + "x" * 30), (13, "Same, here: " + "x" * 30)]
    texts = [None, "", "!!", say(40)]
    for k, text in items[:9] + items[12:13]:
        for n in (0, 2, 4, 6, 9, 14):
            texts.append(f"{say(rng.randint(0, 12))}\n{edited(rng, text, n).upper()}... {say(rng.randint(0, 12))}")
    texts.append(items[0][1][:30])
    size, step = 48, 24
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    items += [(None, say(20)), (None, say(18)), (3, say(16))]  # without an id, and two under one id
    texts += [f"{say(4)} {items[k][1]} {say(3)}" for k in (-1, -2, -3)] + [say(3) + norm(items[2][1])[7:7 + size] + "zz" + say(3)]
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminations(df.drop("item_id"), bench, window=size, step=step).collect()}
    want = {(i, k) for i, t in enumerate(texts) for k, x in items for w in windows(x or "", size, step)
            if held(w, norm(t or ""), min(int(D.RATE * len(w)), len(w) // D.Q - 1))}
    want |= {(i, k) for i, t in enumerate(texts) for k, x in items for s in range(len(norm(x or "")) - size + 1) if norm(x)[s:s + size] in norm(t or "")}
    assert got == want and len(want) > 20
    small = {(r["doc_id"], r["item_id"]) for r in D.contaminations(df.drop("item_id"), bench, window=size, step=step, block_chars=200).collect()}
    assert small == want
    kept = D.clean(df, bench, window=size, step=step)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(texts))) - {i for i, _ in want})


def test_passages_do_not_cross_documents_and_edges(spark):
    passage = "one passage of a benchmark item that is long enough to be cut into windows of a hundred characters each"
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    df = spark.createDataFrame([(1, passage[:52]), (2, passage[52:]), (3, "lead " * 40_000 + passage), (4, passage), (4, passage)], "doc_id long, text string")
    got = [(r["doc_id"], r["offset"]) for r in D.contaminations(df, bench).collect()]
    assert sorted(d for d, _ in got) == [3, 4, 4] and abs(dict(got)[3] - 200_000) <= 40
    assert D.contaminations(df.limit(0), bench).count() == 0
    assert D.contaminations(df, bench.limit(0)).count() == 0 and D.clean(df, bench.limit(0)).count() == 5


def test_planted_passages_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, x in zip(bench.item_id, bench.text) if norm(x) in norm(t)}
    got = {(r["doc_id"], r["item_id"]) for r in D.op3_benchmark_decontamination(spark, sf).collect()}
    assert want and want <= got and len(got) <= len(want) + 3


def test_excerpts_of_the_window_length_are_found_at_all_offsets():
    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))
    item = say(60)
    index, letters = D.build_index([(1, item)]), D._letters()
    own = norm(item)
    texts = [f"{say(5)} # {own[s:s + D.WINDOW]} # {say(5)}" for s in range(len(own) - D.WINDOW + 1) if own[s] != " " and own[s + D.WINDOW - 1] != " "]
    assert {t for t, *_ in D.find_regions(texts, index, letters)} == set(range(len(texts))) and len(texts) > 100
    short = [f"{say(5)} # {own[s:s + 60]} # {say(5)}" for s in range(0, 200, 7)]
    assert D.find_regions(short, index, letters) == []


def test_a_phrase_that_all_items_share_costs_little():
    import time
    import tracemalloc
    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(n))
    phrase = "answer the following question about the passage by one letter of the four"
    assert 65 < len(phrase) < 80
    items = [(k, f"{phrase} {say(25)}") for k in range(250)]
    texts = [f"{say(50)}. {phrase}: {say(45)}" for _ in range(300)] + [items[7][1], say(9) + items[200][1].upper() + say(9)]
    index, letters = D.build_index(items), D._letters()
    tracemalloc.start()
    begin = time.process_time()
    found = D.find_regions(texts, index, letters)
    spent, peak = time.process_time() - begin, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(t, i) for t, i, *_ in found} == {(300, 7), (301, 200)}
    assert spent < 8 and peak < 500e6  # traced; a third of it without


def test_scripts_beyond_the_first_planes():
    assert D.normalise(["ａｂｃ。「HELLO」 日本𝟗"], D._letters())[0].tolist()[:-1] == [ord(c) for c in "ａｂｃ hello 日本𝟗"]
