import hashlib
import random
import re

from candlewick.llm import secret_scan as S

KINDS = ("assign", "access", "hex")


def brute(text):
    rules = ((re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
             (re.compile("AKIA[A-Z0-9]+"), 0, 18), (re.compile("[0-9a-f]+"), 0, 16))
    spans = [(m.start(), k, m.end()) for k, (rule, group, least) in enumerate(rules)
             for m in rule.finditer(text or "") if len(m[group]) >= least]
    return sorted(spans)


def test_pattern_spans_against_brute_force(spark):
    rng = random.Random(3)
    bits = ["token", "TOKEN", "Api_Key", "apikey", "paſſword", "password", " = ", ": ", '"', "'", "AKIA", "AKIAAKIA", "deadbeef" * 2,
            "deadbeef", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "x", "é", " ", "\n", "=", "/+._-", "toKKen", "passwd:hunter2hunter2"]
    texts = [None, "", " " * 10, "0" * 200_000, "İ token = abcdefghijkl0123"] + ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "s", i) for i, t in enumerate(texts)], "doc_id long, text string, spans string, found long")
    got = {r["doc_id"]: r for r in S.scan_secrets(docs).collect()}
    for i, text in enumerate(texts):
        base, r = brute(text), got[i]
        named = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == j for _, k, _ in base) for j in range(3)], text
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == named
        assert r["spans"] == ",".join(f"{f['kind']}:{f['start']}:{f['end']}" for f in r["found"])


def test_novelty_reports_the_incompressible_only(spark):
    key = "q7Zp2Lw9XbV4mTk1RsYc8NdE"
    texts = [f"my secret is {key} ok", "the secret is getElementByIdaddEventListener1 here", f"nothing here {key} at all",
             "secret " + "Abcabc123" * 8, f"repeat {key} and {key} then the private {key}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in S.scan_secrets(docs).collect()}
    assert got[0]["spans"] == f"novel:13:{13 + len(key)}"
    assert [got[i]["n_novel"] for i in (1, 2, 3)] == [0, 0, 0]


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "token = abcdefghijkl0")] * 2 + [(None, "token = abcdefghijkl0")], "doc_id long, text string")
    assert S.scan_secrets(docs.limit(0)).count() == 0
    assert [r["n_assign"] for r in S.scan_secrets(docs).collect()] == [1, 1, 1]


def test_novelty_in_texts_that_lower_casing_lengthens(spark):
    key = "q7Zp2Lw9XbV4mTk1RsYc8NdE"
    texts = [f"İstanbul: the SECRET is {key} ok", f"the Secret is {key}, İİ", f"the to\u212aen is {key}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in S.scan_secrets(docs).collect()}
    assert got == {0: f"novel:24:{24 + len(key)}", 1: f"novel:14:{14 + len(key)}", 2: f"novel:13:{13 + len(key)}"}


def test_long_keys_before_their_word(spark):
    rng = random.Random(5)
    key = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=120))
    texts = [f"{key} is the secret", f"the secret is {key}", f"some words first, then {key} is the secret", f"{key[:30]} {'is ' * 12}the secret",
             f"{key} {'is ' * 30}the secret", "x " * 40 + f"{key[:64]} secret"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in S.scan_secrets(docs).collect()}
    assert got == {0: "novel:0:120", 1: "novel:14:134", 2: "novel:23:143", 3: "novel:0:30", 4: "", 5: "novel:80:144"}


def plain_novel(text, reach=64, around=256, least=16, novelty=0.93, letters=28):
    """Every run against every sensitive word and every pattern span, one by one."""
    import zstandard
    primer = zstandard.ZstdCompressionDict(S.IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=3, dict_data=primer, write_content_size=False, write_checksum=False)
    size = lambda x: len(packer.compress(x.encode()))
    words = [m.span() for w in S.SENSITIVE for m in re.finditer(w, text, re.I)]
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=.-]{%d,}" % least, text):
        (a, b), run = m.span(), m[0]
        near = any(s <= b + reach and e >= a - reach for s, e in words)
        free = not any(s < b and a < e for s, _, e in brute(text))
        kinds = sum(any(c in x for c in run[1:]) for x in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
        long = any(len(x) >= letters for rule in ("[a-z]+", "[A-Z]+", "[0-9]+") for x in re.findall(rule, run))
        if near and free and (kinds > 1 or long):
            around_it = text[max(0, a - around):a] + text[b:b + around]
            if 8 * (size(around_it + run) - size(around_it)) >= novelty * S.capacity(run) * len(run):
                out.append(f"novel:{a}:{b}")
    return out


def test_novel_spans_against_brute_force(spark):
    rng = random.Random(9)
    key = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    low, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    bits = ["secret", "the credential", "Bearer", "token", "token=abcdefghijkl", "deadbeefdeadbeef", " ", "\n", " is ", "getElementById.addEventListener", "a/b/c/d/e/f/g/h/i/j", "é"]
    texts = []
    for _ in range(150):
        keys = [key(low, 40), key(upper + digits, 30), key(low + upper + digits, 20), key("0123456789ABCDEF", 64), key(digits, 30), key(low, 18)]
        texts.append(" ".join(rng.choices(bits + keys, k=rng.randint(2, 40))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith("novel")] for r in S.scan_secrets(docs).collect()}
    assert got == {i: plain_novel(t) for i, t in enumerate(texts)} and sum(map(len, got.values())) > 50


def test_keys_of_small_alphabets_and_long_words(spark):
    rng = random.Random(11)
    lower, hexes, digits = ("".join(rng.choices(x, k=n)) for x, n in (("abcdefghijklmnopqrstuvwxyz", 40), ("0123456789ABCDEF", 256), ("0123456789", 40)))
    texts = [f"my credential is {lower}", f"the secret {hexes} end", f"token of {digits}", "secret internationalization of this", "password docs/getting-started/with-the-authorization/index.html",
             "private Donaudampfschifffahrtsgesell"]
    got = {r["doc_id"]: r["n_novel"] for r in S.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0}  # 2 is a hex span


def test_time_is_linear_in_a_text():
    import time
    rng = random.Random(2)
    scan = S.scan_udf().func
    import pandas as pd
    spent = []
    for n in (1500, 6000):
        text = " ".join(f"secret {rng.getrandbits(100):026x} token{rng.getrandbits(80)}Ab" for _ in range(n))
        begin = time.process_time()
        next(scan(iter([pd.Series([text])])))
        spent.append(time.process_time() - begin)
    assert spent[1] < 9 * spent[0] + 1
