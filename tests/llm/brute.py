"""Plain versions of operators, for tests: no shared code with the operators but their fixed numbers."""

import re
from collections import defaultdict

from seqloom.llm import linededup as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def form(line):
    tokens = WORD.findall(line)
    masked = ["<*>" if re.search("[0-9]", t) else t for t in tokens]
    return tuple(masked) if tokens and 2 * sum(t != "<*>" for t in masked) >= len(tokens) else tuple(tokens)


def dedup_lines(rows, min_docs=2, min_tokens=3, short_docs=3):
    """rows: (id, text), ids distinct or null. The text that is left, by position in rows."""
    key = lambda r: (2**63 - 1 if r[0] is None else r[0], r[1] or "")
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(f := form(line)) >= min_tokens:
                holders[f].add(key(r))
    docs = {f: len(h) for f, h in holders.items()}
    support = lambda n: min_docs if n >= L.LONG_TOKENS else short_docs
    d = L.DEPTH
    first = {}
    for wild in (False, True):  # the own path, then the wildcard children for the rare forms that it leaves alone
        leaves = defaultdict(list)
        for f in holders:
            if len(f) > d and not wild:
                leaves[0, len(f), f[:d]].append(f)
            elif len(f) > d and docs[f] < L.FIELD_DOCS:
                for i in range(d):
                    leaves[i + 1, len(f), f[:i] + f[i + 1:d + 1]].append(f)
        for (path, n, start), forms in list(leaves.items()):
            if path:  # tokens at the wildcard's place that few documents have
                few = defaultdict(int)
                for f in forms:
                    few[f[path - 1]] += docs[f]
                few = {t: k for t, k in few.items() if k < L.FIELD_DOCS}
                worth = len(few) > 1 and sum(few.values()) >= L.WILD_DOCS
                leaves[path, n, start] = [f for f in forms if f[path - 1] in few and f not in first] if worth else []
        kinds = defaultdict(dict)  # form: {path: (constants of FIELD_DOCS documents, of two), each as (place, token)}
        for (path, n, start), forms in leaves.items():
            if len(forms) < 2 or sum(docs[f] for f in forms) < (L.WILD_DOCS if wild else support(n)) or (path == 0 and min(docs[f] for f in forms) >= L.FIELD_DOCS):
                continue
            places = range(d if path == 0 else d + 1, n)
            seen = defaultdict(int)
            for f in forms:
                for p in places:
                    seen[p, f[p]] += docs[f]
            for f in forms:
                kinds[f][path] = tuple((path, n, start, frozenset((p, f[p]) for p in places if seen[p, f[p]] >= s)) for s in (L.FIELD_DOCS, 2))
        for s, long in ((0, False),) if wild else ((0, False), (1, True)):
            groups = defaultdict(list)
            for f in kinds:
                if f in first or (long and len(f) < L.LONG_TOKENS):
                    continue
                for p in kinds[f]:
                    if len(kinds[f][p][s][3]) + d >= L.CONSTANT * len(f):
                        groups[kinds[f][p][s]].append(f)
            new = {}
            for name, forms in groups.items():
                if len(forms) > 1 and sum(docs[f] for f in forms) >= (L.WILD_DOCS if wild else support(name[1])):
                    keeper = min(min(holders[f]) for f in forms)
                    for f in forms:
                        new[f] = min(new.get(f, (name[0], keeper)), (name[0], keeper))
            first |= {f: k for f, (_, k) in new.items()}
    for f in holders:
        if f not in first and docs[f] >= support(len(f)):
            first[f] = min(holders[f])
    out = []
    for r in rows:
        if r[1] is None:
            out.append(None)
        else:
            out.append("\n".join(x for x in r[1].split("\n") if first.get(form(x), key(r)) == key(r)))
    return out
