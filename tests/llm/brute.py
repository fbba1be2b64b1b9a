"""Plain versions of the operators, and odd tables to hold them against."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def remainder(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5


def odd_rows():
    """Nulls in every column, empty, short, long, tied and repeated rows, and texts of many scripts."""
    base = "the cat sat on the mat and looked at the moon over the hills while rain fell on the old town".split()
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    texts = ["", " ", "\n\n", "one", "One two three four", " ".join(base), " ".join([*base, "again"]), " ".join(base), "á ß é 日本語 words here", "x" * 5000, long, long + " tail", "token = \"abcdef123\" AKIA" + "A1" * 9, "0123456789abcdef0123456789abcdef", "same line\nsame line\nsame line\n", "퟿\u0000 nul", "<|endoftext|> <|im_end|>"]
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    return [*rows, (100, None, None, None, None), (None, "no id but some words here now", "en", "s1", 5), (5, texts[5], "en", "s0", len(texts[5])), (5, texts[5], "en", "s0", len(texts[5]))]


def odd(spark):
    df = spark.createDataFrame(odd_rows(), DDL)
    return df.selectExpr("*", "1 as length", "'x' as word", "2 as node", "3 as rank", "4 as row", "5 as n", "true as kept", "6 as piece")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def components(rows, p=75, q=100):
    """Component of each row by place: the least non-null id of those that can be reached."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    inverse = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter()
        for x in s:
            shared.update(inverse[x])
            inverse[x].append(i)
        for j, o in shared.items():
            if q * o >= p * (len(s) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), d if not sets[i] else least.get(find(i))) for i, (d, _) in enumerate(rows)]


def base_metrics(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), again, len(covered)


def contamination(text, items, window=10):
    w = ITEM_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for key, item in items:
        v = ITEM_WORD.findall((item or "").translate(LOWER))
        size = min(window, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(key))
    return len(w), len(hit), sorted(found)


def kept_texts(rows, order=5, z=4.0, least=1.0, odd=2.8, switch=2.0):
    """Verdicts of (lang, text) rows: base rules, then bands of the bits a byte under a plain interpolated Kneser-Ney model of the running text."""

    def words_of(text):
        pads, out = [0] * (order - 2) + [0x20], []
        seq = list(pads)
        for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
            start = len(seq)
            seq += [*w, 0x20]
            out.append([tuple(seq[i - order + 1 : i + 1]) for i in range(start, len(seq))])
        return out

    counts = defaultdict(Counter)
    for lang, text in rows:
        for word in words_of(text):
            counts[lang or "und"].update(word)
    models = {}
    for lang, top in counts.items():
        levels = [top]
        for _ in range(order - 1):
            levels.insert(0, Counter(g[1:] for g in levels[0]))
        model = []
        for c in levels:
            n = [max(1, sum(v == i for v in c.values())) for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2])
            d = [0, *(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i - 0.1) for i in (1, 2, 3))]
            total, taken = Counter(), Counter()
            for g, v in c.items():
                total[g[:-1]] += v
                taken[g[:-1]] += d[min(v, 3)]
            model.append((c, d, total, taken))
        models[lang] = model

    def p(model, gram):
        if not gram:
            return 1 / 256
        c, d, total, taken = model[len(gram) - 1]
        lower, head = p(model, gram[1:]), gram[:-1]
        if head not in total:
            return lower
        return (max(c[gram] - d[min(c[gram], 3)], 0) + taken[head] * lower) / total[head] if c[gram] else taken[head] / total[head] * lower

    bits = lambda model, word: -sum(math.log2(p(model, g)) for g in word)
    measured = []
    for lang, text in rows:
        ws, total = words_of(text), 0.0
        for w in ws:
            own = bits(models[lang or "und"], w)
            if own > odd * len(w):
                own = min([own, *(bits(m, w) + switch for m in models.values())])
            total += own
        n = sum(map(len, ws))
        m = base_metrics(text)
        measured.append((lang or "und", m[0] < 10 or 100 * m[4] > 20 * m[0], n, total / n if n else None))
    at = lambda xs, q: sorted(xs)[max(0, math.ceil(q * len(xs)) - 1)]
    bands = {}
    for lang in counts:
        mine = [(n, x) for g, failed, n, x in measured if g == lang and not failed and x is not None]
        if mine:
            mid = at([x for _, x in mine], 0.5)
            far = [(x - mid) * math.sqrt(n) for n, x in mine]
            bands[lang] = mid, max(-at(far, 0.25) / 0.6745, least), max(at(far, 0.75) / 0.6745, least)
    out = []
    for lang, failed, n, x in measured:
        if failed or x is None or lang not in bands:
            out.append((failed, False, x))
            continue
        mid, below, above = bands[lang]
        out.append((False, mid - z * below / math.sqrt(n) <= x <= mid + z * above / math.sqrt(n), x))
    return out


def toxic_rows(text, decode):
    """Feature rows of a text, word by word: the word without its edges and its beginnings; of disguised words and spelled rows also what `decode` restores. And two or three neighbours as one word."""
    letter = lambda c: 0x61 <= c <= 0x7A or c >= 0x80
    core = lambda c: letter(c) or 0x30 <= c <= 0x39 or c == 0x40
    row = lambda w: {w} | {(w[:n], n) for n in (4, 5, 6, 7) if len(w) > n} if w else set()
    out, lone, cores = [], b"", []

    def close():
        if len(lone) >= 3:
            whole = decode(lone.decode("utf-8", "replace")).encode()
            out.append(row(whole))
            text_ = whole.decode()
            out.extend({x.encode()} for x in {text_[i : i + n] for n in range(3, 17) for i in range(len(text_) - n + 1)})
            out.extend(row(x.encode()) for x in decode.parted(text_) if x != text_ and len(x) not in range(3, 17))

    for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(LOWER).encode()):
        inside = [i for i, c in enumerate(w) if core(c)]
        s, e = (inside[0], inside[-1] + 1) if inside else (0, 0)
        if inside:
            left, right = 0 < s <= 2 and w[s - 1] == 0x24, 0 < len(w) - e <= 2 and w[e] == 0x24
            s, e = 0 if left else s, len(w) if right else e
        w = w[s:e]
        out.append(row(w))
        cores.append(w)
        same = [a == b_ and 0x61 <= a <= 0x7A for a, b_ in zip(w, w[1:])]  # noqa: B905
        signs = sum(not letter(c) for c in w)
        alike = sum(c in b"013456789@$!|+(<*" for c in w)
        letters, digits = len(w) - signs, sum(0x30 <= c <= 0x39 for c in w)
        disguised = letters >= 1 and (0 < signs <= 2 * letters or signs == alike > 0) or not letters and alike == len(w) and 2 * digits <= len(w)
        if len(w) >= 3 and (disguised or letters >= 2 and (any(a and b_ for a, b_ in zip(same, same[1:])) or sum(same) > 2)):  # noqa: B905
            out.extend(row(x.encode()) for x in decode.readings(w.decode("utf-8", "replace")))
        if len(w) == 1:
            lone += w
        else:
            close()
            lone = b""
    close()
    together = [cores[i : i + n] for n in (2, 3) for i in range(len(cores) - n + 1)]
    return [r for r in out if r], [{b"".join(x)} for x in together if all(x) and any(len(w) > 1 for w in x)]
