"""Fingerprints and their likeness against plain loops written from the definition."""

import random

from ordertide.llm import fingerprint as fp


def plain_fingerprint(text):
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return "0::"
    rolled = []
    for i in range(len(data)):
        r = sum(int(fp._ROLL[data[i - j]]) * 0x01000193 ** j for j in range(fp.WINDOW) if i >= j)
        rolled.append((r + 1) % 2**32)

    def signature(k):
        marks, chunk = [], []

        def close():
            h = sum(int(fp._CHUNK[b]) * pow(fp._BASE, i, 2**64) for i, b in enumerate(chunk)) % 2**64
            h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
            marks.append("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[(h ^ h >> 31) >> 58])

        for b, v in zip(data, rolled, strict=True):
            chunk.append(b)
            if v % (3 << k) == 0:
                close()
                chunk = []
        if chunk:
            close()
        return "".join(marks)

    k = 0
    while 3 * fp.USUAL * 2**k <= len(text) - 1:
        k += 1
    while sum(v % (3 << k) == 0 for v in rolled) >= fp.LONGEST:
        k += 1
    return f"{k}:{signature(k)}:{signature(k + 1)}"


def plain_alike(a, b):
    if a == b:
        return 1.0 if a else 0.0
    n = min(len(a), len(b), fp.COMMON)
    if not n or not any(a[i:i + n] in b for i in range(len(a) - n + 1)):
        return 0.0
    away = [[i + j for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            away[i + 1][j + 1] = away[i][j] if x == y else 1 + min(away[i][j + 1], away[i + 1][j])
    return 1 - away[-1][-1] / (len(a) + len(b))


def plain_likeness(x, y):
    if x == y:
        return 1.0
    a, b = ({int(p[0]): p[1], int(p[0]) + 1: p[2]} for p in (x.split(":"), y.split(":")))
    return max((plain_alike(a[k], b[k]) for k in a.keys() & b.keys()), default=0.0)


def some_texts():
    rnd = random.Random(5)
    words = [f"{rnd.choice('abcdefgh')}{i}" for i in range(300)] + ["zażółć", "文字", "𝄞", "\ud800"]
    texts = ["", "a", "ab", "a" * 700, "ab" * 400, "\n", "\x00" * 300]
    for n in (1, 3, 7, 30, 60, 200, 700):
        texts += [" ".join(rnd.choices(words, k=n)) for _ in range(3)]
    return texts, rnd


def test_fingerprint_is_the_plain_one():
    for text in some_texts()[0]:
        assert fp.fingerprint(text) == plain_fingerprint(text)


def test_likeness_is_the_plain_one():
    texts, rnd = some_texts()
    texts += [t[:len(t) // 3] + "changed" + t[len(t) // 2:] for t in texts if len(t) > 40]
    texts += [t + " " + rnd.choice(texts) for t in texts if len(t) > 40]
    prints = [fp.fingerprint(t) for t in texts]
    for x in prints:
        for y in prints:
            assert abs(fp.likeness(x, y) - plain_likeness(x, y)) < 1e-9
