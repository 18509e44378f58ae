"""Plain versions of the operators, for small inputs."""

import math
import re
from html.parser import HTMLParser

import zstandard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, a):
        while self.parent[a] != a:
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard_components(docs):
    """docs: [(id, text)] with distinct ids -> {id: (n, component)}"""
    sets = {i: shingles(t) for i, t in docs}
    u = Union(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                u.join(a, b)
    return {i: (len(sets[i]), u.find(i)) for i in ids}


def cut(docs, length=100):
    """docs: [(id, text)] in corpus order -> [(id, bytes, removed flags)]"""
    seen, out = set(), []
    for i, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            else:
                seen.add(w)
        out.append((i, raw, gone))
    return out


def kept(raw, gone):
    return bytes(c for c, g in zip(raw, gone, strict=True) if not g)


def spans(gone):
    return sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))


def quality(text):
    """(words, code points in words, symbols, repeated lines, words in repeated three-word windows)"""
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines, seen, again = (text or "").split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            again += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(hit)


def within_bands(raw):
    """Whether zstandard ratios of a text and of its 4096-byte chunks are plausible; limits by length written out."""
    if not raw:
        return False
    ratio = lambda x: len(x) / len(zstandard.compress(x, 3))

    def plausible(x):
        top, size = 2.0, 512
        while size < len(x):
            top, size = top + 0.1, 2 * size
        return (1.05 if len(x) < 512 else 1.2 if len(x) < 2048 else 1.35) <= ratio(x) <= top + 1e-12

    odd = 0
    for chunk in [raw[k : k + 4096] for k in range(0, len(raw), 4096)]:
        fine = 1.35 <= ratio(chunk) <= 2.4 if len(chunk) == 4096 else plausible(chunk)
        odd += 0 if fine else len(chunk)
    return plausible(raw) and 2 * odd < len(raw)


class Dom(HTMLParser):
    """The tree of a well-formed page: [tag, path, children], text as strings."""

    def __init__(self, html):
        super().__init__()
        self.root = ["", "", []]
        self.open = [self.root]
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        up = self.open[-1]
        node = [tag, f"{up[1]}/{tag}.{dict(attrs).get('class', '')}", []]
        up[2].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if data.strip():
            self.open[-1][2].append(" ".join(data.split()))


def style_tree(pages):
    """html of the pages of one site, block elements without purpose only -> {path: (pages, content, layout)}"""
    there, layouts, blocks = {}, {}, {}
    for k, html in enumerate(pages):
        stack = [Dom(html).root]
        while stack:
            _, path, inside = stack.pop()
            tags = tuple(x[0] for x in inside if not isinstance(x, str))
            if inside:
                there.setdefault(path, set()).add(k)
            if tags:
                layouts.setdefault(path, {}).setdefault(tags, set()).add(k)
            for x in inside:
                if isinstance(x, str):
                    blocks.setdefault(path, {}).setdefault(x, set()).add(k)
                else:
                    stack.append(x)
    out = {}
    for path, own in there.items():
        m = len(own)
        if m < 2:
            continue
        total = sum(map(len, layouts.get(path, {}).values()))
        layout = -sum(len(x) / total * math.log(len(x) / total) for x in layouts.get(path, {}).values()) / math.log(m) if total else 0.0
        total = sum(map(len, blocks.get(path, {}).values()))
        # entropy over the pages of a block found on n of them: log n
        content = 1 - sum(len(x) * math.log(len(x)) for x in blocks.get(path, {}).values()) / total / math.log(m) if total else 1.0
        out[path] = m, 1 - (1 - content) * (1 - 1 / m), 1 - (1 - layout) * (1 - 1 / m)
    return out


#: Headings, labels and parts of lists and tables.
WHOLE = ("h1", "h2", "li", "th", "td", "tr", "dt", "dd", "caption")


def site_text(html, tree, ratio=0.3, share=0.05):
    """Text of a page without the branches whose importance is low beside that of their neighbours."""

    def kept(node, layout):
        tag, path, inside = node
        layout = max(layout, tree.get(path, (1, 1.0, 1.0))[2]) if path else 0.0
        own = [x for x in inside if isinstance(x, str)]
        parts = [(x, *kept(x, layout)) for x in inside if not isinstance(x, str)]
        parts = [p for p in parts if p[2]]
        if own:
            parts.append((None, tree.get(path, (1, 1.0, 1.0))[1] * (1 + layout) / 2, sum(map(len, own)), own))
        total = sum(p[2] for p in parts)
        best = max((p[1] for p in parts if p[2] >= share * total), default=0)
        stay = [p for p in parts if p[1] >= ratio * best or p[0] and p[0][0] in WHOLE]
        chars = sum(p[2] for p in stay)
        texts = {id(p[0]): p[3] for p in stay}
        out = []
        for x in inside:
            if not isinstance(x, str):
                out += texts.get(id(x), [])
            elif id(None) in texts:
                out.append(x)
        return (sum(p[1] * p[2] for p in stay) / chars if chars else 0.0), chars, out

    return " ".join(kept(Dom(html).root, 0.0)[2])
