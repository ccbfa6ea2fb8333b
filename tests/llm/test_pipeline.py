"""The whole pipeline against plain Python, stage after stage, on documents that every stage has work with."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

import corpus_pipeline
from tablewright.llm import mixing, near_duplicates, pii, quality
from tests.llm.test_operators import BRUTE

SF = "/root/testdata/sf0.001"
SPACES = re.compile(r"[\x20\t-\r]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return [w for w in SPACES.split(text or "") if w]


def measures(text):
    """base_failed and the rules' measures of one text."""
    words, text = words_of(text), text or ""
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    repeated = len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)})
    lines = [x for x in text.split("\n") if words_of(x)]
    chars = sum(map(len, words))
    share = lambda part, whole: part / whole if whole else 0.0
    count = lambda pattern: len(re.findall(pattern, text))
    return len(words) < 20 or 100 * repeated > 30 * len(words), {
        "symbol_share": share(count(r"[#*$%&|<>]"), chars), "upper_share": share(count("[A-Z]"), chars),
        "mark_share": share(count("[!?]"), chars), "dup_line_share": share(len(lines) - len(set(lines)), len(lines)),
        "repeat_share": share(repeated, len(words)),
    }


def stratum(lang):
    return lang if re.fullmatch("[a-z]{2,3}", lang or "") else ""


def good_ones(docs, labels):
    """Rejects by the base rules and by the best cutoff that exact binomial sums admit; also the cutoffs."""
    found = {d["doc_id"]: measures(d["text"]) for d in docs}
    good = {}
    for row in labels:
        if row["doc_id"] is not None and row["quality"] is not None:
            good[row["doc_id"]] = good.get(row["doc_id"], False) or row["quality"] == 1
    held = defaultdict(list)
    for d in docs:
        failed, values = found[d["doc_id"]]
        if d["doc_id"] in good and not failed:
            held[stratum(d["lang"])].append((good[d["doc_id"]], values))
    level = quality.DELTA / max(1, len(held))
    tail = lambda n, k: 1.0 if k >= n * quality.RISK else sum(
        math.comb(n, i) * quality.RISK**i * (1 - quality.RISK) ** (n - i) for i in range(k + 1))
    few = {s for s, rows in held.items() if tail(sum(g for g, _ in rows), 0) > level}
    cutoffs = {}
    for members in [few, *({s} for s in held.keys() - few)]:
        rows = [x for s in members for x in held[s]]
        limits, best = {}, (0, None)
        for cut in quality.CUTOFFS:
            for rule in quality.RULES:
                limits[rule] = cut
                out = [g for g, v in rows if any(v[r] > c for r, c in limits.items())]
                if tail(sum(g for g, _ in rows), sum(out)) > level:
                    break
                if len(out) - 2 * sum(out) > best[0]:
                    best = (len(out) - 2 * sum(out), dict(limits))
            else:
                continue
            break
        cutoffs |= {(s, r): c for s in members for r, c in (best[1] or {}).items()}
    over = lambda d: any(found[d["doc_id"]][1][r] > cutoffs.get((stratum(d["lang"]), r), math.inf) for r in quality.RULES)
    return [d for d in docs if not found[d["doc_id"]][0] and not over(d)], cutoffs


def one_of_each_group(docs):
    sets = {}
    for d in docs:
        w = words_of(lowered(d["text"]))
        sets[d["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = Counter(p for ids in holders.values() for p in combinations(sorted(ids), 2))
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return [d for d in docs if root[d["doc_id"]] == d["doc_id"]]


def not_from_the_benchmark(docs, benchmark):
    windows = set()
    for row in benchmark:
        w = ITEM_WORD.findall(lowered(row["text"]))
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    out, sizes = [], {len(x) for x in windows}
    for d in docs:
        w = ITEM_WORD.findall(lowered(d["text"]))
        hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(d)
    return out


URL = re.compile(r"[A-Za-z0-9+.-]{1,32}://[^\s/?#@<>\"']{1,256}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]{1,5})?(?:/[^\s<>\"']*)?")
CUE = "|".join(sorted({x for c in pii.CUES for x in (c, c.capitalize(), c.upper())}, key=len, reverse=True))
NUMBER = re.compile(
    rf"(?<![^\W_])(?:{CUE})(?=[ \t:#=-]|[nN]|[iI])(?:[ \t]{{0,4}}(?i:number|num\.?|no\.?|nr\.?|id|is|:|#|=|-)){{0,4}}[ \t]{{0,4}}"
    r"([0-9](?:[ -]?[0-9]){5,16}(?![0-9A-Za-z]))"
)


def without_personal_data(docs):
    out = []
    for d in docs:
        text, found = d["text"], []
        for rank, (kind, pattern) in enumerate(BRUTE.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                        "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                    found.append((m.start(), rank, m.end(), kind))
        more = [(m.start(), 4, m.end(), "url") for m in URL.finditer(text)]
        more += [(m.start(1), 5, m.end(1), "account") for m in NUMBER.finditer(text)]
        found += [x for x in more if not any(s <= x[0] and x[2] <= e for s, _, e, _ in found)]
        parts, at = [], 0
        for start, _, end, kind in sorted(found):
            if start >= at:
                parts += [text[at:start], f"<{kind.upper()}>"]
            at = max(at, end)
        clean = "".join(parts) + text[at:]
        out.append(d | {"text": clean, "n_chars": len(clean)})
    return out


def mixed(docs):
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += len(d["text"])
    total, weight = sum(sizes.values()), sum(n**mixing.ALPHA for n in sizes.values())
    out = []
    for d in docs:
        size = sizes[d["source"]]
        rate = size**mixing.ALPHA / weight * total / size
        md5 = lambda *x: hashlib.md5(":".join(map(str, (mixing.SEED, *x))).encode()).hexdigest()
        u, n, term = int(md5(d["doc_id"])[:13], 16) / 16**13, 0, math.exp(-rate)
        below = term
        while below <= u:
            n += 1
            term *= rate / n
            below += term
        out += [d | {"copy": k, "shuffle_key": md5("order", d["doc_id"], k)} for k in range(1, n + 1)]
    return out


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The smallest tables, and a language with labels enough for a cutoff on marks."""
    top = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(11)
    new, marks = [], []
    for i in range(2700):
        words = [f"v{rng.randrange(50_000)}" for _ in range(25)]
        bad = i >= 2600
        text = " ".join(w + "!!" if bad else w for w in words)
        if i % 9 == 0:
            text += rng.choice([" mail to joe.doe@host.example.org", " account no. 12345678 ok", " see ftp://joe:pw@host.org/x now",
                                " call +49 (30) 555-0199 now", " 4111 1111 1111 1111", " at 10.0.0.1 today"])
        new.append((1_000_000 + i, text, "xx", ("wide", "narrow")[i % 5 == 0], len(text)))
        if i < 2660:
            marks.append((1_000_000 + i, int(not bad), 0))
    for i in range(0, 40, 2):  # near copies, one word apart
        text = new[i][1] + " more"
        new.append((2_000_000 + i, text, "xx", "narrow", len(text)))
    for name, rows in (("documents", new), ("labels", marks), ("benchmark", [])):
        given = spark.read.parquet(f"{SF}/{name}.parquet")
        given.unionByName(spark.createDataFrame(rows, given.schema)).write.parquet(f"{top}/{name}.parquet")
    return top


def test_pipeline_equals_plain_python(spark, corpus):
    rows = lambda name: [r.asDict() for r in spark.read.parquet(f"{corpus}/{name}.parquet").collect()]
    docs = rows("documents")
    good, cutoffs = good_ones(docs, rows("labels"))
    assert ("xx", "mark_share") in cutoffs
    single = one_of_each_group(good)
    fresh = not_from_the_benchmark(single, rows("benchmark"))
    clean = without_personal_data(fresh)
    assert len(docs) > len(good) > len(single) > len(fresh) and clean != fresh
    want = Counter(tuple(sorted(d.items())) for d in mixed(clean))
    got = Counter(tuple(sorted(r.asDict().items())) for r in corpus_pipeline.run(spark, corpus).collect())
    assert got == want


def test_one_row_of_each_group_stays_with_or_without_ids(spark):
    base = " ".join(f"word{i}" for i in range(200))
    near = [base + f" tail{i}" for i in range(3)]
    other = " ".join(f"other{i}" for i in range(50))
    rows = [(None, t) for t in near] + [(None, other), (None, other), (7, other + " x"), (7, "a b c"), (7, "d e f g"), (None, ""), (None, None), (1, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, root string")
    found = sorted(((r.doc_id, r.text) for r in near_duplicates.deduplicate(docs, size=5).collect()), key=str)
    without = [(i, t) for i, t in found if t not in near]
    assert len(found) - len(without) == 1
    # a text with an id goes before those without; null and empty texts without an id are one text
    assert [(i, t or "") for i, t in without] == sorted([(7, other + " x"), (7, "a b c"), (7, "d e f g"), (None, ""), (1, "")], key=str)
    assert near_duplicates.deduplicate(docs.where("doc_id IS NULL"), size=5).count() == 3


def test_five_words_keep_texts_that_two_words_merge(spark):
    words = [f"w{i}" for i in range(100)]
    changed = [f"x{i}" if i % 20 == 10 else w for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed))], "doc_id long, text string")
    assert near_duplicates.deduplicate(docs).count() == 1 and near_duplicates.deduplicate(docs, size=5).count() == 2
