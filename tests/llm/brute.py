"""Plain Python versions of the contracts, for small inputs. Rows are dicts."""

from __future__ import annotations

import base64
import hashlib
import html
import re
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s) -> str:
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def lower_az(s: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def repeats(docs, width=35):
    """op1: {position in docs: (doc_id, n_words, n_removed, kept_sha256)}."""
    words = [WORD.findall(d["text"] or "") for d in docs]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for d, w in zip(docs, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((d["doc_id"], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def lines(docs):
    """op4."""
    holders = defaultdict(set)
    key = lambda x: lower_az(x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i or 0)
    for d in docs:
        for x in (d["text"] or "").split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(d["doc_id"])
    out = []
    for d in docs:
        ls = (d["text"] or "").split("\n")
        keep = [x for x in ls if len(holders.get(key(x), ())) < 2 or min(holders[key(x)], key=order) == d["doc_id"]]
        out.append((d["doc_id"], len(ls), len(ls) - len(keep), sha("\n".join(keep))))
    return out


def bpe_encoding(path, pattern):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokens(docs, enc):
    """op5."""
    out = []
    for d in docs:
        ids = enc.encode_ordinary(d["text"] or "")
        out.append((d["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(d["text"] or "")))
    return out


def shingles(text, k=4):
    w = WORD.findall(lower_az(text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near(docs, percent=85, k=4):
    """op6."""
    sets = [shingles(d["text"], k) for d in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    root = components(len(docs), links)
    least = {}
    for d, r in zip(docs, root):
        least[r] = min(least.get(r, d["doc_id"]), d["doc_id"])
    return [(d["doc_id"], len(s), least[r]) for d, s, r in zip(docs, sets, root)]


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(docs):
    """op7, base spans only."""
    out = []
    for d in docs:
        t = d["text"] or ""
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        n = Counter(k for _, k, _ in spans)
        names = ["assign", "access", "hex"]
        out.append((d["doc_id"], n[0], n[1], n[2], sha(",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans)))))
    return out


def quality(docs):
    """op9, base columns."""
    out = []
    for d in docs:
        t = d["text"] or ""
        w = WORD.findall(t)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = Counter(tri)
        rep = {j for i, x in enumerate(tri) if n[x] > 1 for j in range(i, i + 3)}
        ls = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        out.append((d["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(rep), failed))
    return out


def kept_by_quality(docs):
    """op9: which docs stay, with the verdicts on their hosts."""
    hard = [q[-1] for q in quality(docs)]
    soft = [2 * q[3] > q[1] or 2 * q[4] > q[1] for q in quality(docs)]
    failed = [a or b for a, b in zip(hard, soft)]
    hosts = defaultdict(list)
    for d, f in zip(docs, failed):
        hosts[d["source"]].append(f)
    rates = [sum(f) / len(f) for f in hosts.values()]
    m = sum(rates) / len(rates) if rates else 0.0
    chance = m * (1 - m)
    s = 10.0  # one host, or rates at both ends
    if len(rates) > 1:
        v = sum((r - m) ** 2 for r in rates) / (len(rates) - 1) - chance * sum(1 / len(f) for f in hosts.values()) / len(hosts)
        if v <= 0 or chance == 0:
            s = 1e9
        elif v < chance:
            s = chance / v - 1
    rejected = set()
    for h, f in hosts.items():
        p = (sum(f) + m * s) / (len(f) + s)
        if p - 2 * (p * (1 - p) / (len(f) + s + 1)) ** 0.5 > min(1.5 * m, 0.5):
            rejected.add(h)
    return [not a and not (b and d["source"] in rejected) for d, a, b in zip(docs, hard, failed)]


def line_texts(docs):
    """op4: the texts that stay, for docs whose doc_ids differ."""
    key = lambda x: lower_az(x.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for d in docs:
        for x in map(key, (d["text"] or "").split("\n")):
            first[x] = min(first.get(x, d["doc_id"]), d["doc_id"])
    keeps = lambda d, x: len(key(x)) < 10 or first[key(x)] == d["doc_id"]
    return ["\n".join(x for x in (d["text"] or "").split("\n") if keeps(d, x)) for d in docs]


def mix(docs):
    """op3: copies of every doc."""
    size = [len(WORD.findall(d["text"] or "")) for d in docs]
    place = [hashlib.md5(f"mix-1:{d['doc_id']}:{d['text'] or ''}".encode()).hexdigest()[:9] for d in docs]
    names = sorted({d["source"] for d in docs}, key=lambda x: (x is None, x or ""))
    weight = {x: (3, 1, 2)[i % 3] for i, x in enumerate(names)}
    whole = {x: sum(n for d, n in zip(docs, size) if d["source"] == x) for x in names}
    target, left, rest = {}, Fraction(3 * sum(whole.values()), 2), sum(weight.values())
    for x in sorted(names, key=lambda x: Fraction(2 * whole[x], weight[x])):
        target[x] = min(Fraction(2 * whole[x]), left / rest * weight[x])
        left, rest = left - target[x], rest - weight[x]
    copies = [0] * len(docs)
    for x in names:
        full = target[x] // whole[x] if whole[x] else 0
        left, groups = target[x] - full * whole[x], defaultdict(list)
        for i, d in enumerate(docs):
            if d["source"] == x:
                groups[place[i]].append(i)
                copies[i] = min(2, int(full))
        for _, ids in sorted(groups.items()):
            n = sum(size[i] for i in ids)
            if n > left and n - left >= left:
                break
            for i in ids:
                copies[i] = min(2, copies[i] + 1)
            if n > left:
                break
            left -= n
    return copies


def corpus(docs, enc):
    """The pipeline: (doc_id, n_tokens, ids digest, text digest, ids) of every row."""
    docs = [d for d, ok in zip(docs, kept_by_quality(docs)) if ok]
    docs = [{**d, "text": t} for d, t in zip(docs, line_texts(docs))]
    docs = [d for d, n in zip(docs, near(docs, 80, 5)) if n[2] == d["doc_id"]]
    docs = [d for d, n in zip(docs, mix(docs)) for _ in range(n)]
    return [(*t, tuple(enc.encode_ordinary(d["text"]))) for d, t in zip(docs, tokens(docs, enc))]


USER = re.compile(r"""(?:user(?:_?name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", re.I | re.A)
ENDPOINT = re.compile(
    r"(?:https?|ftp|jdbc:[a-z]+|mongodb|postgres(?:ql)?|mysql|redis|amqp)://([^\x20\x09-\x0D:@/]{1,64}:[^\x20\x09-\x0D@/]{1,128}@)?[A-Za-z0-9.-]+(?::[0-9]+)?"
)
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,63}")


def secret_spans(docs, scope=200):
    """op7: (doc_id, spans, n_weak, n_credentials) with the linked parts."""
    secret, owner = {"assign", "hex", "mixed", "key_block", "short"}, {"access", "user", "email"}
    order = ["assign", "access", "hex", "user", "mixed", "endpoint", "email", "key_block", "short", "connection"]
    out = []
    for d in docs:
        t = d["text"] or ""
        strong = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
        strong += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        strong += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]{32,}", t)]
        whole = [(m.start(), "connection", m.end()) for m in ENDPOINT.finditer(t) if m[1]]
        weak = [(m.start(), "user", m.end()) for m in USER.finditer(t)]
        weak += [(m.start(), "mixed", m.end()) for m in re.finditer("[A-Za-z0-9+/]{20,}", t) if all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]"))]
        weak += [(m.start(), "endpoint", m.end()) for m in ENDPOINT.finditer(t) if not m[1]]
        weak += [(m.start(), "email", m.end()) for m in EMAIL.finditer(t)]
        weak += [(m.start(), "key_block", m.end()) for m in re.finditer("-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", t)]
        weak += [(m.start(), "short", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) < 8]
        weak = [w for w in weak if not any(s[0] < w[2] and w[0] < s[2] for s in strong + whole)]
        blank = lambda a, b: re.search(r"\n[ \t\r]*\n", t[min(a[2], b[2]) : max(a[0], b[0])])
        told, n = set(whole), len(whole)
        for z in strong + weak:
            if z[1] in secret:
                near = [p for p in strong + weak if p[1] in owner | {"endpoint"} and p[0] <= z[2] + scope and p[2] + scope >= z[0] and not blank(p, z)]
                near = [p for p in near if p[1] != "access" or p[2] <= z[0] or p[0] >= z[2]]
                if any(p[1] in owner for p in near):
                    n += 1
                    told.update(p for p in [z, *near] if p not in strong)
        spans = sorted([*strong, *told], key=lambda p: (p[0], order.index(p[1])))
        out.append((d["doc_id"], ",".join(f"{k}:{a}:{b}" for a, k, b in spans), len(told), n))
    return out


def article_text(page):
    """op10, for pages whose text is one article of headings and paragraphs."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    cut = re.sub(r'<!--.*?-->|<(script|style|aside|nav|footer|form)\b.*?</\1>|<div class="[^"]*">.*?</div>', "", inner[1] if inner else "", flags=re.S)
    parts = re.split(r"</?(?:p|h[1-6]|ul|ol|li|blockquote|div)\b[^>]*>", re.sub(r"<br[^>]*>", " ", cut))
    texts = [" ".join(html.unescape(re.sub("<[^>]*(?:>|$)", "", x)).split()) for x in parts]
    return "\n\n".join(x for x in texts if x)


def vectors(rows, cosine=0.98):
    """op8, for rows of distinct vec_ids: (vec_id, n_links, component_id, kept)."""
    import numpy as np

    x = [np.asarray(np.float32(r["embedding"]), float) for r in rows]
    x = [v / np.linalg.norm(v) for v in x]
    links = [(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if rows[a]["label"] == rows[b]["label"] is not None and x[a] @ x[b] >= cosine]
    root, n, least = components(len(x), links), Counter(i for pair in links for i in pair), {}
    for r, k in zip(rows, root):
        least[k] = min(least.get(k, r["vec_id"]), r["vec_id"])
    return [(r["vec_id"], n[i], least[root[i]], r["vec_id"] == least[root[i]]) for i, r in enumerate(rows)]


def hard_negatives(rows):
    """op11."""
    import math

    v = []
    for r in rows:
        x = r["embedding"]
        if r["vec_id"] is None or r["label"] is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        v.append((r["vec_id"], label, [math.floor(256 * c) for c in x]))
    out = []
    for i, (anchor, label, q) in enumerate(v):
        if anchor % 50:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(q, p)), vec_id, lab) for j, (vec_id, lab, p) in enumerate(v) if j != i)
        for ps, positive, _ in [x for x in ranked if x[2] == label][:5]:
            ok = [x for x in ranked if x[2] != label and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out += [(anchor, positive, k + 1, vec_id, -ps, -ns) for k, (ns, vec_id, _) in enumerate(ok)]
    return out


def audit(docs, labels):
    """op12."""
    from itertools import permutations

    good = {x["doc_id"] for x in labels if x["quality"] == 1 and x["doc_id"] is not None}
    toxic = {x["doc_id"] for x in labels if x["toxic"] == 1 and x["doc_id"] is not None}
    smallest = {}
    for d in docs:
        if d["doc_id"] is not None:
            t = d["text"] or ""
            smallest[t] = min(smallest.get(t, d["doc_id"]), d["doc_id"])
    failed = []
    for d in docs:
        t = d["text"] or ""
        w = WORD.findall(t)
        e = d["doc_id"] is not None and smallest[t] < d["doc_id"]
        bad = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)), e]
        failed.append((d["lang"] or "", d["doc_id"], {c for c, b in zip("ABCDE", bad) if b}))
    rows = []
    for part in sorted({f[0] for f in failed}):
        mine = [f[1:] for f in failed if f[0] == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            for i, c in enumerate(order):
                here = [x for x, bad in mine if c in bad and not bad & set(order[:i])]
                total[c] += len(here)
                rows.append([
                    part, order, i + 1, sum(not bad & set(order[: i + 1]) for _, bad in mine), len(here), sum(c in bad for _, bad in mine) - len(here),
                    sum(bad == {c} for _, bad in mine), sum(x in good for x in here), sum(x in toxic for x in here), c,
                ])
        for r in rows:
            if r[0] == part:
                r[-1] = total[r[-1]]
    return [tuple(r) for r in rows]
