"""Operators again in plain Python, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict
from math import exp, log

import regex
import xxhash

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, sources=None):
    rows = [(k if not isinstance(text, tuple) else text[0], text if not isinstance(text, tuple) else text[1],
             "en", (sources or ["a"])[k % len(sources or ["a"])], None) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENT)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def lines_kept(docs, width=3):
    """docs: (id, text), ids unique. Text left of each."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.sha256((d[1] or "").encode()).digest()[:16]))
    seen, gone = set(), defaultdict(set)
    for doc, text in order:
        lines = (text or "").split("\n")
        for at in range(len(lines) - width + 1):
            window = tuple(lines[at:at + width])
            if window in seen:
                gone[doc].update(range(at, at + width))
            seen.add(window)
    return {doc: text if doc not in gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[doc])
            for doc, text in docs}


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower_ascii(text or ""))


def contaminated(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        found = words(text)
        for at in range(max(1, len(found) - width + 1)):
            if found:
                windows[tuple(found[at:at + width])].add(None if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        found, hit, ids = words(text), set(), set()
        for size in sizes:
            for at in range(len(found) - size + 1):
                if (w := tuple(found[at:at + size])) in windows:
                    hit |= set(range(at, at + size))
                    ids |= windows[w] - {None}
        out.append((doc, len(found), len(hit), sorted(ids)))
    return out


def near(docs, items, width, slop):
    """(doc, words, hit words, items) with all words of a window within a stretch of its size plus `slop`, in any order."""
    out = []
    for doc, text in docs:
        found, hit, ids = words(text), set(), set()
        for item, item_text in items:
            terms = words(item_text)
            for first in range(max(1, len(terms) - width + 1) if terms else 0):
                window = Counter(terms[first:first + width])
                reach = sum(window.values()) + slop
                for start in range(len(found)):
                    for end in range(start + 1, min(start + reach, len(found)) + 1):
                        if found[start] in window and found[end - 1] in window and window <= Counter(found[start:end]):
                            hit |= set(range(start, end))
                            ids.add(str(item))
        out.append((doc, len(found), len(hit), sorted(ids)))
    return out


def mixing_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: words of each source. What each source should have."""
    weight = {name: weights[k % len(weights)] for k, name in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, rest, out = sum(sizes.values()), set(sizes), {}
    while rest:
        share = left / sum(weight[name] for name in rest)
        above = {name for name in rest if weight[name] * share > most * sizes[name]}
        if not above:
            return out | {name: weight[name] * share for name in rest}
        out |= {name: float(most * sizes[name]) for name in above}
        left -= sum(out[name] for name in above)
        rest -= above
    return out


def repeated_bytes(texts, length):
    """(bytes, removed runs, kept) of each text."""
    data = [(text or "").encode() for text in texts]
    count = Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if count[d[k:k + length]] > 1:
                gone[k:k + length] = b"\x01" * length
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out.append((len(d), runs, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def fingerprint(text, shingle=4, seed=42):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not found:
        return 0
    pieces = [" ".join(found[k:k + shingle]) for k in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def log_scores(texts, order=2, backoff=0.4, min_count=1):
    tokens = [words(t) for t in texts]
    count = Counter(tuple(t[k:k + n]) for t in tokens for n in range(1, order + 1) for k in range(len(t) - n + 1))
    total = sum(map(len, tokens))

    def score(gram):
        if len(gram) == 1:
            return log(count[gram] / total)
        if count[gram] >= min_count:
            return log(count[gram] / count[gram[:-1]])
        return log(backoff) + score(gram[1:])

    return [(len(t), sum(score(tuple(t[max(0, k - order + 1):k + 1])) for k in range(len(t)))) for t in tokens]


def log_scores_by_others(texts, order=2, backoff=0.4):
    """The same for each text by the counts of all others; a word of no other text scores backoff / all words."""
    tokens = [words(t) for t in texts]
    grams = [Counter(tuple(t[k:k + n]) for n in range(1, order + 1) for k in range(len(t) - n + 1)) for t in tokens]
    total = sum(grams, Counter())
    out = []
    for t, own in zip(tokens, grams, strict=True):
        others = max(1, sum(map(len, tokens)) - len(t))

        def score(gram, own=own, others=others):
            if not gram:
                return -log(others)
            if seen := total[gram] - own[gram]:
                return log(seen / (total[gram[:-1]] - own[gram[:-1]] if len(gram) > 1 else others))
            return log(backoff) + score(gram[1:])

        out.append((len(t), sum(score(tuple(t[max(0, k - order + 1):k + 1])) for k in range(len(t)))))
    return out


def collocations(docs, min_count=10, top=2000, percent=50):
    """docs: (lang, text). Rows (lang, rank, phrase, a, l, r, n, score)."""
    count, sizes = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower_ascii(text or "")):
            found = re.findall("[^ \t]+", piece)
            sizes[lang] += len(found)
            for size in (1, 2, 3):
                count.update((lang, tuple(found[k:k + size])) for k in range(len(found) - size + 1))
    scored = defaultdict(list)
    longer = Counter()
    for (lang, p), a in count.items():
        if len(p) == 3 and a >= min_count:
            for part in (p[:2], p[1:]):
                longer[lang, part] = max(longer[lang, part], a)
    for (lang, p), a in count.items():
        if len(p) > 1 and a >= min_count and not (len(p) == 2 and 100 * longer[lang, p] >= percent * a and longer[lang, p]):
            cuts = [(count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min((10**6 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            scored[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return [(lang, rank, p.decode(), -a, l, r, sizes[lang], -s)
            for lang, some in scored.items() for rank, (s, a, p, l, r) in enumerate(sorted(some)[:top], 1)]


SPACE = " \t\n\x0b\x0c\r"


def statistics(text):
    """The statistics of the quality classifier, by name."""
    text = text or ""
    tokens = [word for word in re.split(f"[{SPACE}]+", text) if word]
    lines = [line for line in text.split("\n") if line.strip(" ")]
    n_chars, n_words, n_lines = max(1, len(text)), max(1, len(tokens)), max(1, len(lines))
    count = lambda pattern: len(regex.findall(pattern, text))
    alike = sum(a == b for a, b in zip(bounded(text), bounded(text)[1:], strict=False) if a)
    return {
        "log_words": log(1 + len(tokens)), "word_length": len(text) / n_words, "capitals": count(r"\p{Lu}") / n_chars,
        "digits": count(r"\p{Nd}") / n_chars, "symbols": count(rf"[^\p{{L}}\p{{M}}\p{{Nd}}{SPACE}.,]") / n_chars,
        "bars": text.count("|") / n_words, "marked_words": count(rf"[^\p{{L}}\p{{M}}\p{{Nd}}{SPACE}]{{2,}}+") / n_words,
        "stutter": alike / n_words, "distinct_words": len(set(tokens)) / n_words,
        "distinct_lines": len(set(lines)) / n_lines, "line_words": len(tokens) / n_lines,
    }


def bounded(text):
    """Words and, between words that more than one blank parts, empty ones."""
    return re.split(f"[{SPACE}]", text)


def rule_score(intercept, rules, stats):
    """The logistic score of weighted rules whose conditions all hold."""
    total = intercept
    for conditions, weight in rules:
        if all(stats[name] <= bound if sign == "<=" else stats[name] > bound for name, sign, bound in conditions):
            total += weight
    return 1 / (1 + exp(-total))
