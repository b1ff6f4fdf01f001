"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def tokenizer():
    import base64

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(runs)
    covered = {j for i, r in enumerate(runs) if seen[r] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    n = len(words)
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_duplicates(rows, size=5, percent=75):
    sets = {d: shingles(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        met = Counter(e for s in sets[d] for e in holders[s])
        for s in sets[d]:
            holders[s].append(d)
        for e, both in met.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {(d, len(sets[d]), root(d)) for d in sets}


def cut_passages(rows, length=35):
    words = {d: WORD.findall(t or "") for d, t in rows}
    seen = Counter(tuple(w[i : i + length]) for w in words.values() for i in range(len(w) - length + 1))
    out = set()
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.add((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())))
    return out


def _weights(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def leaks(rows, items, size=5, percent=75):
    """(doc_id, item_id, windows that pass, best similarity)"""
    out = set()
    for d, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        if not words:
            continue
        for item, body in items:
            want = WORD.findall((body or "").translate(LOWER))
            if not want:
                continue
            own, width = _weights(want, size), min(len(words), len(want))
            passed = []
            for i in range(len(words) - width + 1):
                w = _weights(words[i : i + width], min(size, len(want)))
                same = sum((own & w).values())
                either = sum((own | w).values())
                if 100 * same >= percent * either:
                    passed.append(same / either)
            if passed:
                out.add((d, item, len(passed), round(max(passed), 9)))
    return out


def chats(rows):
    """(conv_id, turns) of maximal conversations."""
    own = defaultdict(set)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].add((-1 if turn is None else turn, role or "unknown", text or ""))
    whole = {c: tuple(x[1:] for x in sorted(t)) for c, t in own.items()}
    parts = {t[:k] for t in whole.values() for k in range(1, len(t))}
    first = {}
    for c in sorted(whole):
        if whole[c] not in parts:
            first.setdefault(whole[c], c)
    shown = lambda r: r.replace("<|", "< |").translate({10: " ", 13: " "})
    return {(c, len(t), "".join(f"<|im_start|>{shown(r)}\n{x.replace('<|', '< |')}<|im_end|>\n" for r, x in t)) for t, c in first.items()}


def url_parts(url, rules):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = [(len(r), r, v) for v, r in rules if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def damaged(rows):
    """(conv_id, turn, role, text) rows after the faults that crc32 chooses."""
    import zlib

    out = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def _edits(rows):
    """(cost, audit, result) of rows (role, text, must go, open end): all ways, from the last row back, least cost and then least audit."""
    after = {"": (0, "", []), "s": None, "u": None, "a": (0, "", [])}

    def better(x, y):
        return y if x is None or (y is not None and y[:2] < x[:2]) else x

    def insertions(best):
        for _ in range(4):
            for state in best:
                to, role = ("a", "assistant") if state == "u" else ("u", "user")
                if best[to] is not None:
                    best[state] = better(best[state], (best[to][0] + 3, "I" + best[to][1], [(role, ""), *best[to][2]]))
        return best

    after = insertions(after)
    for role, text, must_go, open_end in reversed(rows):
        now = {}
        for state in after:
            best, extra = None, 3 if open_end else 0
            if after[state] is not None:
                best = better(best, (after[state][0] + 4, "D" + after[state][1], after[state][2]))
            if not must_go:
                fits = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[:1] in fits and after[role[0]] is not None:
                    rest = after[role[0]]
                    best = better(best, (rest[0] + extra, "K" + rest[1], [(role, text), *rest[2]]))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if to in fits:
                        rest = after[to]
                        best = better(best, (rest[0] + 3 + extra, "R" + rest[1], [(name, text), *rest[2]]))
            now[state] = best
        after = insertions(now)
    return after[""]


def repairs(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired turns)"""
    chats = defaultdict(list)
    for conv, turn, role, text in rows:
        chats[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, turns in chats.items():
        turns.sort()
        seen, judged, count = set(), [], Counter()
        for _, _, role, text in turns:
            core = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            count[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        places = {t[1] for t in turns if t[0]}
        gaps = max(places) - min(places) + 1 - len(places) if places else 0
        cost, audit, result = _edits(judged)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, result)
    return out
