"""The same answers by plain Python, for tables small enough."""

import math
import re

WHITE = "\x20\x09-\x0d"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(f"[{WHITE}]+", low) if w]


def shingles(text, size):
    own = words(text)
    size = min(size, len(own))
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()


def components(ids, links):
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def near_documents(rows, size, percent):
    """Component of each document by comparing all pairs."""
    sets = {i: shingles(text, size) for i, text in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return components(ids, links)


def line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def without_lines(rows):
    """Text left and lines dropped of each document."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(line_key(line)) >= 20:
                holders.setdefault(line_key(line), set()).add(i)
    gone = {key: max(ids) for key, ids in holders.items() if len(ids) >= 3}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or gone.get(line_key(x), i) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def letters(text):
    return "".join(c.lower() if c.isalpha() else " " for c in text)


def trigrams(text):
    """Runs of three signs, words set apart by blanks, that are not all but blank."""
    low = f"  {letters(text)}  "
    runs = [low[i : i + 3] for i in range(len(low) - 2)]
    return [x for x in runs if not (x[1] == " " and " " in (x[0], x[2]))]


def _steps(likely, shares, rounds):
    """Expectation maximisation: the shares after some rounds, and the log likelihood before the last."""
    total, fit = sum(n for n, _ in likely), None
    for _ in range(rounds):
        sums, fit = [0.0] * len(shares), 0.0
        for n, own in likely:
            each = [p * s for p, s in zip(own, shares, strict=True)]
            fit += n * math.log(sum(each))
            sums = [a + n * e / sum(each) for a, e in zip(sums, each, strict=True)]
        shares = [x / total for x in sums]
    return shares, fit


def mixture(counts, logs, rounds=10, set_rounds=4):
    """Numbers and shares of the chosen languages, the largest share first.

    ``counts``: how often each trigram occurs; ``logs``: its log likelihood in each language.
    """
    likely = [(n, [math.exp(x - max(own)) for x in own]) for n, own in zip(counts, logs, strict=True)]
    n_langs = len(logs[0])
    shares, _ = _steps(likely, [1 / n_langs] * n_langs, rounds)
    order = sorted(range(n_langs), key=lambda k: -shares[k])
    price, best, answer = 0.5 * math.log(max(sum(counts), 2)), -math.inf, None
    for k in range(1, n_langs + 1):
        chosen = order[:k]
        first = [shares[x] if x in chosen else 0.0 for x in range(n_langs)]
        if k == 1:
            own, fit = [float(x in chosen) for x in range(n_langs)], sum(n * math.log(max(p[chosen[0]], 1e-30)) for n, p in likely)
        else:
            own, fit = _steps(likely, [x / sum(first) for x in first], set_rounds)
        if fit - (k - 1) * price > best:
            best, answer = fit - (k - 1) * price, sorted(((x, own[x]) for x in chosen), key=lambda y: -y[1])
        elif k >= 3:
            break
    return answer


def gradient_steps(bags, labels, vectors, layer, offsets, orders, rate):
    """A softmax layer over the mean of bucket vectors, one step for each document, in lists of numbers."""
    steps, done, size = sum(map(len, orders)), 0, len(layer)
    for order in orders:
        for d in order:
            pace = rate * (1 - done / steps)
            done += 1
            mean = [sum(w * vectors[b][j] for b, w in bags[d]) for j in range(size)]
            out = [math.exp(sum(mean[j] * layer[j][c] for j in range(size)) + offsets[c]) for c in (0, 1)]
            error = [x / sum(out) - (labels[d] == c) for c, x in enumerate(out)]
            slope = [sum(layer[j][c] * error[c] for c in (0, 1)) for j in range(size)]
            for b, w in bags[d]:
                vectors[b] = [v - pace * w * s for v, s in zip(vectors[b], slope, strict=True)]
            fall = 1 - (done - 1) / steps
            layer = [[layer[j][c] - 0.5 * fall * mean[j] * error[c] for c in (0, 1)] for j in range(size)]
            offsets = [offsets[c] - 0.01 * fall * error[c] for c in (0, 1)]
    return vectors, layer, offsets
