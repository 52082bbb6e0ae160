"""Language ID, toxicity chain and URL filter against plain versions that share
no code with them."""

import html
import math
import random
import re
import urllib.parse
from collections import Counter

import numpy as np
import pytest
import xxhash

from regiscope.llm import langid, queries, toxicity, url_filter

# op1


def gram_bucket(gram):
    h = 0
    for n, c in enumerate(gram, 1):
        h = (h + ord(c) + n) * 0x9E3779B97F4A7C15 % 2 ** 64
        h ^= h >> 29
    return h >> (64 - langid.BUCKETS.bit_length() + 1)


def grams(text):
    t = text.lower()
    return Counter(gram_bucket(t[i:i + n]) for n in langid.ORDERS for i in range(len(t) - n + 1))


def test_op1_equals_counter_naive_bayes(spark):
    rnd = random.Random(2)
    alphabets = {"en": "abcde ", "de": "dexyzß ", "ru": "абвг ", "xx": "ab12 "}
    rows = [(i, "".join(rnd.choice(alphabets[g]) for _ in range(rnd.randrange(0, 60))), g)
            for i, g in enumerate(rnd.choice(list(alphabets)) for _ in range(120))]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    counts, docs = {g: Counter() for g in alphabets}, Counter(g for _, _, g in rows)
    for _, t, g in rows:
        counts[g] += grams(t)
    tests = ["abc dea", "ßzy xd", "вгаб", "1212 ab", "a", "é", "ABC", None, "", "12"] + ["".join(
        rnd.choice("abcdexyzвг12 ") for _ in range(rnd.randrange(1, 40))) for _ in range(40)]
    langs, scores = langid.score_texts(model, tests)
    for t, lang, score in zip(tests, langs, scores):
        if not t or not any(c.isalpha() for c in t):
            assert (lang, score) == (langid.UNDETERMINED, 0.0)
            continue
        total = {g: math.log(docs[g] / len(rows)) + sum(
            n * math.log((counts[g][b] + 1) / (sum(counts[g].values()) + langid.BUCKETS)) for b, n in grams(t).items())
            for g in alphabets}
        top = max(total.values())
        p = {g: math.exp(x - top) for g, x in total.items()}
        best = max(sorted(p), key=p.get)
        assert lang == best and score == pytest.approx(p[best] / sum(p.values()), abs=1e-5)


# op2

def plain_features(text):
    words = re.sub(rb"[^0-9a-z\x80-\xff]", b" ", (text or "").lower().encode()).split()
    raw = (text or "").encode()
    out = {xxhash.xxh32_intdigest(w) for w in words} | {xxhash.xxh32_intdigest(w[:5], 1) for w in words}
    n = len(raw) or 1
    return out, [1 - len(set(words)) / (len(words) or 1), sum(33 <= c < 127 and not chr(c).isalnum() for c in raw) / n,
                 sum(65 <= c < 91 for c in raw) / n]


def g_statistic(a, b, c, d):
    n = a + b + c + d
    return 2 * sum(x * math.log(x * n / (r * k)) for x, r, k in (
        (a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d)) if x)


def plain_fit(x, dense, y, rows):
    """Logistic model by full-batch AdaGrad over a dense 0/1 matrix."""
    m = x.shape[1]
    pos, n = sum(y[i] for i in rows), len(rows)
    bias = math.log((pos + 0.5) / (n - pos + 0.5))
    if not n or pos in (0, n):
        return np.zeros(m), np.zeros(dense.shape[1]), bias
    ratio = np.zeros(m)
    for f in range(m):
        p = sum(1 for i in rows if x[i, f] and y[i])
        q = sum(1 for i in rows if x[i, f] and not y[i])
        if g_statistic(p, q, pos - p, n - pos - q) >= toxicity.MIN_G:
            ratio[f] = math.log((p + 0.5) / (pos + 1)) - math.log((q + 0.5) / (n - pos + 1))
    xs, ds, ys = x[rows] * ratio, dense[rows], y[rows]
    w, v = np.zeros(m), np.zeros(dense.shape[1])
    sw, sv, sb = np.full(m, 1e-8), np.full(dense.shape[1], 1e-8), 1e-8
    for _ in range(150):
        err = (1 / (1 + np.exp(-np.clip(bias + xs @ w + ds @ v, -30, 30))) - ys) / n
        gw, gv, gb = xs.T @ err + 1e-3 * w / n, ds.T @ err + 1e-3 * v / n, err.sum()
        sw, sv, sb = sw + gw ** 2, sv + gv ** 2, sb + gb ** 2
        w, v, bias = w - 0.3 * gw / np.sqrt(sw), v - 0.3 * gv / np.sqrt(sv), bias - 0.3 * gb / math.sqrt(sb)
    return w * ratio, v, bias


def test_op2_chain_equals_plain_numpy(spark):
    rnd = random.Random(7)
    vocabulary = [f"word{i}x" for i in range(40)]
    rows, flags = [], []
    for i in range(150):
        bad, rude = i % 3 == 0, i % 5 == 0
        words = [rnd.choice(vocabulary) for _ in range(12)] + ["idiotic"] * bad + ["SCUM!", "scummy"] * rude
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        flags.append((i, int(rude) if i % 4 else None, int(bad or rude)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    y = spark.createDataFrame(flags, "doc_id long, rude int, toxic int")
    chain = toxicity.fit(d, y, ["rude", "toxic"])
    # the sample's order decides the folds
    order = [r.doc_id for r in y.selectExpr("doc_id", "xxhash64(doc_id) AS o").orderBy("o").collect()]
    feats = {i: plain_features(t) for i, t in rows}
    often = sorted(f for f, n in Counter(f for i in order for f in feats[i][0]).items() if n >= toxicity.MIN_DOCS)
    x = np.array([[float(f in feats[i][0]) for f in often] for i in order])
    dense = np.array([feats[i][1] for i in order])
    fold = np.arange(len(order)) % toxicity.FOLDS
    flag = {i: f for i, *f in flags}
    tests = [t for _, t in rows[:20]] + ["idiotic word1x", "SCUM! scummy", "", "nothing known"]
    tx = np.array([[float(f in plain_features(t)[0]) for f in often] for t in tests])
    td = np.array([plain_features(t)[1] for t in tests])
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    want = []
    for c in range(2):
        label = np.array([-1 if flag[i][c] is None else flag[i][c] for i in order], float)
        rows_of = lambda keep: [k for k in range(len(order)) if label[k] >= 0 and keep(k)]
        out = np.zeros(len(order))
        for f in range(toxicity.FOLDS):
            w, v, b = plain_fit(x, dense, label, rows_of(lambda k: fold[k] != f))
            out[fold == f] = sigmoid(b + x @ w + dense @ v)[fold == f]
        w, v, b = plain_fit(x, dense, label, rows_of(lambda k: True))
        p = sigmoid(b + tx @ w + td @ v)
        want.append(p)
        dense, td = np.column_stack([dense, out]), np.column_stack([td, p])
    got = toxicity.score_texts(chain, tests)
    assert np.allclose(got, np.array(want).T, atol=1e-6)


# op3

def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def plain_node(url):
    if url is None or "://" not in url:
        return None
    host, path = plain_split(url)
    query = re.match(r"[^?#]*(?:\?([^#]*))?", url.split("://", 1)[1]).group(1) or ""
    query = "&".join(x for x in query.split("&") if not re.match(r"(utm_[a-z]+|gclid|fbclid)=", x))
    return re.sub(r":(80|443)$", "", host) + path.rstrip("/") + (f"?{query}" if query else "")


def plain_links(url, text):
    if url is None or "://" not in url or text is None:
        return
    for tag in re.findall(r"(?i)<(?:link|meta)\b[^>]*>", text):
        rel = re.search(r"""(?i)\brel\s*=\s*["']?canonical\b""", tag) and tag[:5].lower() == "<link"
        to = re.search(r"""(?i)\b(?:href)\s*=\s*["']?([^"'\s>]+)""" if rel else r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", tag)
        if to and (rel or re.search(r"(?i)http-equiv\s*=\s*[\"']?refresh\b", tag)):
            yield urllib.parse.urljoin(url, html.unescape(to.group(1)))


def plain_judge(pages, rules):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    def rule_of(url):
        host, path = plain_split(url)
        fits = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits and url else (None, None)

    urls = {u for _, u, _ in pages if u is not None}
    for _, u, t in pages:
        for v in plain_links(u, t):
            urls.add(v)
            a, b = find(plain_node(u)), find(plain_node(v))
            parent[max(a, b)] = min(a, b)
    blocked = {find(plain_node(u)) for u in urls if plain_node(u) is not None and rule_of(u)[1] == "block"}
    out = []
    for i, u, _ in pages:
        rule, verdict = rule_of(u) if u is not None else (None, None)
        node = plain_node(u)
        if verdict is None:
            verdict = "block" if node is not None and find(node) in blocked else "allow"
        out.append((i, *plain_split(u), rule, verdict))
    return sorted(out, key=repr)


def test_op3_equals_urllib_version(spark):
    rnd = random.Random(11)
    hosts = ["a.com", "www.example.com", "x.example.com", "b.net", "c.org", "D.ORG"]
    paths = ["/en/1", "/es/x", "/fr/", "/p?a=1&b=2", "/p?a=1&b=2&utm_source=z", "/a/b/c.html", "/a/d", "", "/q#t"]
    targets = ["../d", "?a=1&amp;b=2", "//b.net/es/x", "/en/1", "./c.html", "https://c.org/p?a=1&#38;b=2", "#top", "e/../../d", "http://b.net/fr/"]
    pages = []
    for i in range(120):
        u = f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}{rnd.choice(paths)}"
        to = rnd.choice(targets)
        tag = rnd.choice([f'<link rel="canonical" href="{to}">', f"<meta http-equiv='refresh' content='0;url={to}'>", "<p>", None])
        pages.append((i, u, tag))
    pages += [(500, None, None), (501, "no scheme", '<link rel=canonical href="http://b.net/es/x">')]
    got = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"),
                           spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string"))
    assert sorted((tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr) == \
        plain_judge(pages, queries.URL_RULES)
