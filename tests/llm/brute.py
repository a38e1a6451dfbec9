"""Plain versions of the operators, one text at a time, to hold results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def repeats(docs: list[tuple[int, str | None]], n: int = 20) -> dict[int, tuple[int, int, str]]:
    """Words covered by windows that also start earlier: per id the words, the removed ones, a checksum of the rest."""
    seen: set[tuple[str, ...]] = set()
    result = {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - n + 1):
            window = tuple(own[i : i + n])
            if window in seen:
                gone[i : i + n] = [True] * n
            seen.add(window)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        result[doc_id] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return result


def _lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    own = words(_lower(text or ""))
    if not own:
        return set()
    return {tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))}


def components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """Set size and smallest reachable id per id, from every pair that shares a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for shingle in s:
            holders[shingle].append(d)
    parent = {d: d for d in sets}

    def root(d: int) -> int:
        while parent[d] != d:
            d = parent[d]
        return d

    shared: dict[tuple[int, int], int] = defaultdict(int)
    for held in holders.values():
        held.sort()
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    own = words(text)
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    places = defaultdict(list)
    for i in range(len(own) - 2):
        places[tuple(own[i : i + 3])].append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(3)}
    failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, dup, len(covered), failed


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pii(text: str | None) -> dict[str, list[tuple[int, int]]]:
    found = {}
    for kind, pattern in PII.items():
        found[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": kind == "card" and 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found[kind].append(m.span())
    return found


def url(value: str | None, rules: list[tuple[str, str]]) -> tuple[str, str, str | None]:
    host = path = ""
    if value is not None and "://" in value:
        rest = value.partition("://")[2]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = _lower(host)
    fitting = []
    for _, pattern in rules:
        at, slash, start = pattern.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + start):
            fitting.append(pattern)
    return host, path, max(fitting, key=len, default=None)


def byte_tokenizer():
    """Ids and bytes of a text's tokens by the JSON file's own library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rest = iter(range(256, 512))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_byte = {chr(b if b in printable else next(rest)): b for b in range(256)}

    def encode(text: str) -> tuple[list[int], list[bytes]]:
        coded = tokenizer.encode(text, add_special_tokens=False)
        return coded.ids, [bytes(as_byte[c] for c in t) for t in coded.tokens]

    return encode


def piece_tokenizer():
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def encode(text: str) -> tuple[list[int], list[bytes]]:
        ids = model.encode(text)
        pieces = [model.id_to_piece(i) for i in ids]
        as_byte = {f"<0x{b:02X}>": bytes([b]) for b in range(256)}
        return ids, [as_byte.get(p) or p.replace("▁", " ").encode() for p in pieces]

    return encode


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(rows: list[tuple], group: int | None, heads: int) -> list[tuple]:
    """All nodes of the trie, walked one by one; rows are (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        if group is None:
            built[c] = turns
        else:
            h = zlib.crc32(str(c).encode()) % heads
            base = c - int(math.fmod(c, group))
            built[c] = own.get(base, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[k] for k in below) or 1
        here = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = here + sum(saved[k] for k in below)
    ends = lambda node: sorted(c for c in members[node] if len(built[c]) == len(node))
    return sorted(
        (
            (
                min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n],
                saved[n], hashlib.sha256(",".join(map(str, ends(n))).encode()).hexdigest(),
            )
            for n in members
        ),
        key=str,
    )


def shrunk(rows: list[tuple], limits: tuple[float, float]) -> list[tuple[float, float, float]]:
    """(host rate, path rate, score) of each (log odds, host, path), group by group."""
    p = [1 / (1 + math.exp(-odds)) for odds, _, _ in rows]
    hosts, paths = defaultdict(list), defaultdict(list)
    for x, (_, host, path) in zip(p, rows):
        hosts[host].append(x)
        paths[host, path].append(x)
    mean = lambda xs: sum(xs) / len(xs)

    def strength(groups, parent_of, members) -> float:
        n, parents = len(p), {parent_of(g) for g in groups}
        inside = sum((x - mean(xs)) ** 2 for xs in groups.values() for x in xs)
        between = sum(len(xs) * (mean(xs) - mean(members(g))) ** 2 for g, xs in groups.items())
        spread = inside / (n - len(groups)) if n > len(groups) else 0.0
        size = n - sum(sum(len(xs) ** 2 for g, xs in groups.items() if parent_of(g) == q) / sum(
            len(xs) for g, xs in groups.items() if parent_of(g) == q) for q in parents)
        extra = between - (len(groups) - len(parents)) * spread
        if extra <= 1e-9 or size <= 0:
            return limits[1]
        return min(max(spread * size / extra, limits[0]), limits[1])

    of_host = strength(hosts, lambda g: 0, lambda g: p)
    of_path = strength(paths, lambda g: g[0], lambda g: hosts[g[0]])
    found = []
    for x, (odds, host, path) in zip(p, rows):
        rate = (sum(p) - x) / (len(p) - 1)
        host_rate = (sum(hosts[host]) - x + of_host * rate) / (len(hosts[host]) - 1 + of_host)
        path_rate = (sum(paths[host, path]) - x + of_path * host_rate) / (len(paths[host, path]) - 1 + of_path)
        logit = lambda q: math.log(q / (1 - q))
        found.append((host_rate, path_rate, 1 / (1 + math.exp(-(odds + logit(path_rate) - logit(rate))))))
    return found


def _mixed(v: int) -> int:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        v = (v ^ v >> shift) * factor % 2**64
    return v ^ v >> 31


def tree(text: str) -> str:
    """The Merkle tree of a text, leaf by leaf."""
    raw = text.encode()
    cuts = {m.end() for m in re.finditer(rb"[.!?\n]+", raw)} | ({len(raw)} if raw else set())
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw):
        base = 0x9E3779B97F4A7C15
        if _mixed(sum((b + 1) * pow(base, i, 2**64) for i, b in enumerate(m[0])) % 2**64) % 4 == 0:
            cuts.add(m.end())
        if len(m[0]) > 64:
            for end in range(m.start() + 8, m.end() + 1):
                whole = end == m.end() or raw[end] & 0xC0 != 0x80
                if whole and _mixed(int.from_bytes(raw[end - 8 : end], "big")) % 24 == 0:
                    cuts.add(end)
    # A leaf that ends within a run of sentence ends would not be one: the run belongs to the leaf before it.
    cuts = {c for c in cuts if c == len(raw) or not (raw[c - 1 : c] in b".!?\n" and raw[c : c + 1] in b".!?\n")}
    root, sections, leaves, begin = hashlib.blake2b(digest_size=16), [], [], 0
    for end in sorted(cuts):
        leaves.append(hashlib.blake2b(raw[begin:end], digest_size=8).digest())
        begin = end
        if leaves[-1][7] % 8 == 0 or end == len(raw):
            section = hashlib.blake2b(b"".join(leaves), digest_size=16)
            root.update(section.digest())
            sections.append(section.hexdigest()[:12] + "=" + ",".join(x[:4].hex() for x in leaves))
            leaves = []
    return root.hexdigest() + ":" + ";".join(sections)


def tree_likeness(a: str, b: str) -> float:
    """Twice the leaves that both trees hold, by the leaves of both."""
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    ours, theirs = (re.findall(r"[0-9a-f]{8}(?=[,;]|$)", x.partition(":")[2]) for x in (a, b))
    from collections import Counter

    same = sum((Counter(ours) & Counter(theirs)).values())
    return 2 * same / (len(ours) + len(theirs)) if ours or theirs else 1.0


def _letters(text: str | None) -> list[str]:
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def language_scores(learn: list[tuple], most: dict[int, int]) -> tuple[list[str], dict, dict]:
    """Languages, the known words and n-grams, and the log frequency of each per language, from (text, language) pairs."""
    counts: dict = defaultdict(lambda: defaultdict(int))
    for text, lang in set(learn):
        for word in _letters(text):
            counts[lang, 0][word] += 1
            marked = f" {word} "
            for n in range(1, 6):
                for i in range(len(marked) - n + 1):
                    counts[lang, n][marked[i : i + n]] += 1
    languages = sorted({lang for lang, _ in counts})
    kept = {
        key: dict(sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[: most[key[1]]]) for key, found in counts.items()
    }
    known = {n: set().union(*(kept.get((lang, n), {}) for lang in languages)) if languages else set() for n in range(6)}
    score = {
        (n, gram): [
            math.log(kept.get((lang, n), {}).get(gram, 0) + 0.5)
            - math.log(sum(counts[lang, n].values()) + 0.5 * len(counts[lang, n]) if (lang, n) in counts else 1.0)
            for lang in languages
        ]
        for n in known for gram in known[n]
    }
    return languages, known, score


def language(text: str | None, languages: list[str], known: dict, score: dict) -> tuple[str, float]:
    """The likeliest language of a text, word by word, and its share of the likelihood."""
    total, seen = [0.0] * len(languages), False
    for word in _letters(text):
        seen = True
        rows = [score[0, word]] if word in known[0] else []
        marked = f" {word} "
        for n in (5, 4, 3, 2, 1):
            if rows:
                break
            rows = [score[n, g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in known[n]]
        if rows:
            total = [t + sum(r[k] for r in rows) / len(rows) for k, t in enumerate(total)]
    if not seen or not languages:
        return "und", 0.0
    best = max(range(len(languages)), key=lambda k: (total[k], -k))
    return languages[best], 1 / sum(math.exp(t - total[best]) for t in total)
