import hashlib
import math
import random
import re
from collections import Counter

from tests.conftest import SF0001
from usagelens.llm import url_model
from usagelens.llm.queries import URL_RULES
from usagelens.llm.url_model import ALPHABET, END, HELD_OUT, M, ORDER, START, STEP


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def brute(pages):
    parts = [(p, u or "", *split(u)) for p, u in pages]
    urls = {u: (rule(h, q).verdict if rule(h, q) else None) for _, u, h, q in parts}
    held = {u for u in urls if hashlib.md5(u.encode()).hexdigest()[0] in HELD_OUT}
    counts = {(label, all_): Counter() for label in ("allow", "block") for all_ in (True, False)}
    for u, label in urls.items():
        for all_ in (True, False) if label else ():
            t = START * ORDER + u + END
            for i in range(ORDER, len(t)) if all_ or u not in held else ():
                for k in range(ORDER + 1):
                    counts[label, all_][t[i - k:i], t[i]] += 1
                    counts[label, all_][t[i - k:i]] += 1

    def p(which, context, c):
        lower = p(which, context[1:], c) if context else 1 / ALPHABET
        return (counts[which][context, c] + M * lower) / (counts[which][context] + M)

    def step(u, all_):
        t = START * ORDER + u + END
        total = sum(round(1e6 * (math.log(p(("allow", all_), t[i - ORDER:i], t[i]))
                                 - math.log(p(("block", all_), t[i - ORDER:i], t[i])))) for i in range(ORDER, len(t)))
        return math.floor(total / (len(t) - ORDER) / STEP)

    known = [(step(u, False), urls[u]) for u in held if urls[u]]
    steps = {u: step(u, True) for u in urls if urls[u] is None}
    n = Counter(label for _, label in known)
    best, threshold = 0, 0
    for at in sorted({s for s, _ in known}):
        gain = sum((label == "allow") * n["block"] - (label == "block") * n["allow"] for s, label in known if s >= at)
        if gain > best:
            best, threshold = gain, at
    out = []
    for page, u, h, q in parts:
        r = rule(h, q)
        out.append((page, h, q, r.name if r else None, r.verdict if r else "allow" if steps[u] >= threshold else "block"))
    return out


def run(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string").repartition(3)
    return sorted((tuple(r) for r in url_model.judge(df.withColumn("host", df.page_id), URL_RULES).collect()), key=repr)


ODD = [None, "", "no scheme/x", "://", "http://", "HTTP://WWW.Example.NET/en/x", "http://example.net/en", "http://net/",
       "http://net", "http://internet/x", "http://a.example.com/de/?q=1#z", "x://y.org/fr/1://2", "http://ÉX.org/fr/ü",
       "ftp://example.com#frag/a", "http://example.com?x/de/", "http://a.b.org/FR/", "http://org/fr/" + "long/" * 2000]


def test_against_brute_force(spark):
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()]
    pages += [(9000 + i, u) for i, u in enumerate(ODD)] + [(None, ODD[5]), (9005, ODD[5])]
    got = run(spark, pages)
    assert got == sorted(brute(pages), key=repr)
    assert {r[4] for r in got} == {"allow", "block"}


def test_rules_alone(spark):
    got = {r[0]: r[3:] for r in run(spark, list(enumerate(ODD)))}
    assert got[5] == ("example.net/en/", "allow") and got[6] == ("net/", "block") and got[7] == ("net/", "block")
    assert got[8][0] is None and got[9][0] is None and got[10] == ("example.com/de/", "block")
    assert got[11] == ("org/fr/", "allow") and got[15][0] is None


def test_no_labels_and_no_rows(spark):
    assert run(spark, [(1, "http://a.com/x"), (2, None)]) == [(1, "a.com", "/x", None, "allow"), (2, "", "", None, "allow")]
    assert run(spark, []) == []


def test_the_whole_url_is_read(spark):
    """URLs that differ behind the path alone get verdicts of their own."""
    rng = random.Random(4)
    tails = ["?ok=yes&good=1#fine", "?xx=zzz&bad=0#worse"]
    noise = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(30)))
    pages = [(1000 * n + i, f"http://x{i % 7}.{place}/fr/{noise()}{tails[n]}") for n, place in enumerate(("org", "net"))
             for i in range(150)]
    pages += [(9000 + n, f"http://x1.edu/fr/{end}") for n, end in enumerate(tails)]
    got = run(spark, pages)
    verdict = {r[0]: r[4] for r in got}
    assert (verdict[9000], verdict[9001]) == ("allow", "block") and got == sorted(brute(pages), key=repr)
