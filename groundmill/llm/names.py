"""Variant spellings of names of people and organisations.

A name is read into parts (given name, middle initials, surname or the distinctive word of an organisation,
generation, kind of business). Distinct surnames are joined by a pigeonhole segment join: each is cut
into k + 1 segments, position-shifted substrings of the others are looked up in the inverted index of segments,
and candidates are verified with a banded edit distance (with transpositions). k is the tolerance of the longer of two
keys, so a key is indexed under each that can apply. A transposition over a cut would break two segments; so there are as
many cuts without common places as transpositions are possible, and one more. The join misses no pair within tolerance. Names whose parts agree are
linked; links are consolidated by the grid union-find. An initial or an abbreviation stands for a person only
where one person fits, in the whole collection or else in the same context (claim).

All work is on distinct parsed names, so a name that stands in a third of all rows is one vertex.

Defined cases: null, blank, generic ("the claimant", "staff") and unreadable names link nothing; a name of any
length is read whole; repeated rows count once; empty tables give an empty result.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.common import durable
from groundmill.llm.groups import connected_groups

# Words around names.
TITLES = set("dr mr mrs ms miss prof professor herr frau mme mlle sr. m atty attorney nurse examiner reviewer manager adjuster supervisor specialist appeals physician counsel claims rep case representative judge agent director analyst doctor investigator consultant señor señora".split())
DEGREES = set("rn md phd esq do dds jd pa np mba lcsw psyd dc cpa lpn msw".split())
GENERATIONS = {"jr": "jr", "sr": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "junior": "jr", "senior": "sr"}
GENERIC = set("the a an of claimant insured staff unknown null none n/a na tbd employer provider treating patient caller office self spouse witness team company desk anonymous various same".split())
LEGAL_FORMS = set("llc inc ltd pllc incorporated limited llp lp corp corporation gmbh plc pc".split())
EXPANSIONS = {
    "svcs": "services", "svc": "services", "mgmt": "management", "ctr": "centre", "center": "centre", "grp": "group", "ptnrs": "partners", "assoc": "associates", "assocs": "associates", "admin": "administrators",
    "ins": "insurance", "co": "company", "voc": "vocational", "occ": "occupational", "invest": "investigations", "rehab": "rehabilitation", "neuro": "neurology", "med": "medical", "pt": "physical therapy", "homecare": "home care",
    "orthopedic": "orthopaedic", "counseling": "counselling", "ortho": "orthopaedic", "psych": "psychiatry", "intl": "international", "dept": "department", "hosp": "hospital", "cnslg": "counselling", "bur": "bureau", "rev": "review", "hlth": "health", "imag": "imaging", "phys": "physical", "ther": "therapy", "ben": "benefit", "benefits": "benefit", "cons": "consulting",
}
BUSINESS = set("consulting legal psychiatry bureau claims review company benefit home care services vocational group imaging investigations insurance health associates neurology counselling management orthopaedic centre medical administrators occupational partners rehabilitation therapy physical clinic hospital department international laboratory pharmacy solutions university institute agency bank office".split())
NICKNAMES = """
alexandra lexi sasha alex sandra; alexander alex sandy; anthony tony; charles charlie chuck; dorothy dolly dot dottie; edward ned ed eddie ted; elizabeth betty liz beth eliza lisa; frederick fred fritz freddie; gerald jerry gerry;
henry hank harry; isabella bella izzy; james jamie jim jimmy; katherine kate kit kathy katie; lawrence larry; margaret peggy maggie meg greta; michael mike mick; nathaniel nate nathan; patricia pat trish patty tricia; quincy quin;
richard dick rick rich richie; robert bob rob bobby; susanna sue susan susie; theodore ted teddy theo; theodora theo dora; ursuline ulla; ursula ulla; victoria vicky vicki tori; vincent vince vinnie; william bill will billy; yvonne eve vonnie;
zachary zach zack; zacharias zach; benjamin ben; benedikt ben; christopher chris; daniel dan danny; david dave; deborah deb debbie; joseph joe joey; jonathan jon; matthew matt; matthias matt; nicholas nick; nicodemus nick; rebecca becky; ronald ron; samuel sam;
stephen steve; thomas tom; timothy tim; andrew andy; barbara barb; catherine cathy; donald don; eugene gene; franklin frank; gregory greg; jacqueline jackie; jennifer jen jenny; kenneth ken; leonard len; pamela pam; peter pete; philip phil; raymond ray; sandra sandy; walter walt
"""
_FORMAL: dict[str, set[str]] = {}
for _line in NICKNAMES.replace("\n", " ").split(";"):
    _formal, *_short = _line.split()
    for _n in _short:
        _FORMAL.setdefault(_n, set()).add(_formal)

#: Given names learned from the collection: at least so many names begin with one. They are broadcast, so more than
#: GIVEN_MOST are refused with an error, never cut.
GIVEN_LEAST, GIVEN_MOST = 5, 1_000_000
PLACE = "entity", "record"
PARTS = "kind string, key string, given string, gtype string, middle string, gen string, rest string, inits array<string>"
_COLUMNS = [x.split()[0] for x in PARTS.split(", ")]
_QUOTED = re.compile(r"[\"“'‘(]\s*([^\"”'’()]*?)\s*[\"”'’)]")


def plain(text: str) -> str:
    """Lower case without accents."""
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("æ", "ae").replace("Æ", "Ae"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def _tokens(text: str) -> list[str]:
    """Words; initials written together ("A.J.") come apart, other dots stay at the end of a word."""
    out = []
    for t in re.split(r"[\s,;]+", text):
        t = t.strip("'\"()-")
        if re.fullmatch(r"(?:[^\W\d_]\.){3,}", t):
            out.append(t.replace(".", ""))
        elif re.fullmatch(r"(?:[^\W\d_]\.?){2}", t) and "." in t[:2]:
            out += [c + "." for c in t if c != "."]
        elif t.strip("."):
            out.append(t)
    return out


def is_business(words: list[str]) -> bool:
    bare = {x for w in words for x in EXPANSIONS.get(w.replace(".", ""), w.replace(".", "")).split()}
    return bool(bare & (LEGAL_FORMS | BUSINESS) - {"claims"})


def read_business(words: list[str]) -> tuple | None:
    bare = [w.replace(".", "") for w in words if w not in ("the", "of", "and", "&", "for")]
    bare = [x for w in bare if w not in LEGAL_FORMS for x in EXPANSIONS.get(w, w).split()]
    own = [w for w in bare if w not in BUSINESS]
    if not own:
        return None
    # "X Kind of Business" and "Kind of Business of X": the own word is at either end; misspelt kinds are not
    first, last = own[0] == bare[0], own[-1] == bare[-1]
    key = own[-1] if "of" in words and last else own[0] if first else max(own, key=len)
    rest = bare.copy()
    rest.remove(key)
    return ("org", key, None, None, None, None, " ".join(sorted(set(rest))), ["#"])


def read_name(name: str | None, given_names: dict[str, int]) -> tuple | None:
    """The parts of a name in the order of PARTS, or None where it names nobody."""
    if not name or not name.strip():
        return None
    text = plain(re.sub(r"\([^)]*\)", " ", name))
    nick = None
    if m := re.search(r"[\"“]\s*([^\W\d_]+)\s*[\"”]", text):
        nick, text = m[1], text[: m.start()] + " " + text[m.end() :]
    words = _tokens(text)
    if not words or all(w.rstrip(".") in GENERIC | TITLES for w in words):
        return None
    if is_business(words):
        return read_business(words)
    head, _, tail = text.partition(",")
    drop = lambda ws: [w for w in ws if w.rstrip(".") not in DEGREES and w.rstrip(".") not in GENERATIONS]
    gen = next((GENERATIONS[w.rstrip(".")] for w in words if w.rstrip(".") in GENERATIONS), None)

    def untitled(ws: list[str]) -> list[str]:
        while len(ws) > 1 and ws[0].rstrip(".") in TITLES and (len(ws[0].rstrip(".")) > 1 or len(ws) > 2 and len(ws[1].rstrip(".")) > 1 and ws[0] == "m."):
            ws = ws[1:]
        return ws

    first, second = untitled(drop(_tokens(head))), untitled(drop(_tokens(tail)))
    if first and second:
        last, given = first, second
    else:
        ws = first or second
        if not ws:
            return None
        if len(ws) == 1:
            last, given = ws, []
        elif len(ws[-1].rstrip(".")) == 1 or ws[-1].endswith("."):
            n = len(ws) - 1
            while n > 1 and (len(ws[n - 1].rstrip(".")) == 1 or ws[n - 1].endswith(".")):
                n -= 1
            last, given = ws[:n], ws[n:]
        else:
            a, b = given_names.get(ws[0], 0), given_names.get(ws[-1], 0)
            given, last = (ws[-1:], ws[:-1]) if len(ws) == 2 and b > 3 * max(a, 0) and b >= GIVEN_LEAST else (ws[:1], ws[1:])
            while len(last) > 1 and (len(last[0].rstrip(".")) == 1):
                given, last = [*given, last[0]], last[1:]
    key = re.sub(r"[^\w]", "", "".join(last))
    if len(key) < 2 or key in GENERIC:
        return None
    g = given[0] if given else ""
    bare = g.rstrip(".")
    gtype = "none" if not bare else "init" if len(bare) == 1 else "abbr" if g.endswith(".") else "full"
    middle = "".join(sorted(w[0] for w in given[1:] if w))
    formal = {bare} | _FORMAL.get(bare, set()) | ({nick} if nick else set())
    inits = sorted({f[0] for f in formal if f}) or ["*"]
    return ("person", key, bare, gtype, middle, gen or "", "", inits)


def edit_distance(a: list[str] | np.ndarray, b: list[str] | np.ndarray, most: int) -> np.ndarray:
    """Banded edit distances with transpositions of pairs; ``most`` + 1 where it is larger."""
    n = len(a)
    if not n:
        return np.zeros(0, int)
    la, lb = np.fromiter(map(len, a), int, n), np.fromiter(map(len, b), int, n)
    width = int(max(la.max(), lb.max(), 1))
    x = np.array(a, f"U{width}").view(np.uint32).reshape(n, width)
    y = np.array(b, f"U{width}").view(np.uint32).reshape(n, width)
    big = most + 1
    before = np.full((n, width + 2), big, np.int16)
    row = np.minimum(np.arange(width + 2), big)[None].repeat(n, 0).astype(np.int16)
    out = np.where(la == 0, np.minimum(lb, big), big)
    for i in range(1, width + 1):
        new = np.full((n, width + 2), big, np.int16)
        if i <= most:
            new[:, 0] = i
        for j in range(max(1, i - most), min(width, i + most) + 1):
            cost = (x[:, i - 1] != y[:, j - 1]).astype(np.int16)
            best = np.minimum(np.minimum(row[:, j] + 1, new[:, j - 1] + 1), row[:, j - 1] + cost)
            if i > 1 and j > 1:
                swap = (x[:, i - 1] == y[:, j - 2]) & (x[:, i - 2] == y[:, j - 1])
                best = np.where(swap, np.minimum(best, before[:, j - 2] + 1), best)
            new[:, j] = np.minimum(best, big)
        before, row = row, new
        done = la == i
        if done.any():
            out[done] = new[done, lb[done]]
    return np.minimum(out, big)


@functools.lru_cache(100_000)
def near_words(a: str, b: str, most: int) -> bool:
    """The same distance for one pair of words; words recur, so answers are kept."""
    if abs(len(a) - len(b)) > most:
        return False
    before, row = [], list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        new = [i] * (len(b) + 1)
        for j in range(1, len(b) + 1):
            best = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, before[j - 2] + 1)
            new[j] = best
        if min(new) > most and min(row) > most:
            return False
        before, row = row, new
    return row[-1] <= most


def tolerance(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


@functools.lru_cache(4096)
def cuts(length: int, parts: int, ways: int) -> tuple[tuple[tuple[int, int], ...], ...]:
    """``ways`` cuts of a key into ``parts`` segments (start, length), no two with a common place. The first is even, the
    others move its places by one either way."""
    short, extra = divmod(length, parts)
    even = [i * short + max(0, i - (parts - extra)) for i in range(parts + 1)]
    out = []
    for shift in (0, 1, -1)[:ways]:
        if parts == 2 and even[1] + shift >= length:
            shift = -1
        at = [0, *(x + shift for x in even[1:-1]), length]
        out.append(tuple((a, b - a) for a, b in zip(at, at[1:], strict=False)))
    return tuple(out)


def index_terms(key: str) -> list[str]:
    """Segments of the key for partners that are not shorter: under every tolerance that the longer key can have, in as many
    ways as transpositions are left beside the difference in length."""
    size, ways = len(key), {}
    for more in range(3):
        k = tolerance(size + more)
        if more <= k:
            ways[k] = max(ways.get(k, 0), 1 + k - more)
    return [f"{size}|{k}|{j}|{i}|{key[s : s + n]}" for k, w in ways.items() for j, cut in enumerate(cuts(size, k + 1, w)) for i, (s, n) in enumerate(cut)]


def probe_terms(key: str) -> list[str]:
    """Substrings of the probe that can equal a segment of a key that is not longer."""
    out, size = set(), len(key)
    k = tolerance(size)
    for more in range(min(k, size - 1) + 1):
        length = size - more
        for j, cut in enumerate(cuts(length, k + 1, 1 + k - more)):
            for i, (s, n) in enumerate(cut):
                for p in range(max(0, s - k), min(size - n, s + k) + 1):
                    out.add(f"{length}|{k}|{j}|{i}|{key[p : p + n]}")
    return sorted(out)


def similar_keys(keys: DataFrame) -> DataFrame:
    """(init, a, b, dist) of different keys of one initial within the tolerance, a before b."""

    def terms(f):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for t in batches:
                t["term"] = [f(k) for k in t["key"]]
                yield t[["init", "key", "term"]].explode("term")

        return run

    schema = "init string, key string, term string"
    held = keys.mapInPandas(terms(index_terms), schema).withColumnRenamed("key", "a")
    asked = keys.mapInPandas(terms(probe_terms), schema).withColumnRenamed("key", "b")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t = t.drop_duplicates()
            d = edit_distance(t["a"].tolist(), t["b"].tolist(), 2)
            longest = np.maximum(t["a"].str.len(), t["b"].str.len()).to_numpy()
            t = t.assign(dist=d)[d <= np.where(longest < 4, 0, np.where(longest < 8, 1, 2))]
            swap = t["a"] > t["b"]
            yield pd.DataFrame({"init": t["init"], "a": t["a"].where(~swap, t["b"]), "b": t["b"].where(~swap, t["a"]), "dist": t["dist"]})

    return held.join(asked, ["init", "term"]).filter("a <> b").select("init", "a", "b").mapInPandas(verify, "init string, a string, b string, dist int").distinct()


def _formals(given: str) -> set[str]:
    return {given} | _FORMAL.get(given, set())


def same_given(a: str, b: str, known: dict[str, int], most: int = 2) -> bool:
    """Full given names: equal, a nickname of the other, or a misspelling of at most ``most`` edits (not two names that
    both exist)."""
    if a == b or _formals(a) & _formals(b):
        return True
    if a in known and b in known or min(len(a), len(b)) < 4:
        return False
    return near_words(a, b, 1 if min(len(a), len(b)) < 6 else most)


@functools.lru_cache(100_000)
def same_rest(a: str, b: str) -> bool:
    """Kinds of business, word by word: equal, shortened or misspelt; one may leave out a word of many."""
    x, y = a.split(), b.split()
    if x == y:
        return True
    if not x or not y or abs(len(x) - len(y)) > 1:
        return False
    near = lambda u, v: u == v or len(min(u, v, key=len)) >= 3 and (u.startswith(v) or v.startswith(u)) or min(len(u), len(v)) >= 4 and near_words(u, v, 2)
    small, large = sorted((x, y), key=len)
    left = large.copy()
    for u in small:
        hit = next((v for v in left if near(u, v)), None)
        if hit is None:
            return False
        left.remove(hit)
    return len(small) == len(large)


def relation(p: dict, q: dict, dist: int, known: dict[str, int]) -> str | None:
    """How two parsed names of similar keys relate: same, stands (p stands for q), stood (the reverse), vague."""
    if p["kind"] == "org":
        return "same" if same_rest(p["rest"], q["rest"]) else None
    if p["middle"] and q["middle"] and not set(p["middle"]) & set(q["middle"]):
        return None
    if p["gen"] and q["gen"] and p["gen"] != q["gen"]:
        return None
    full_p, full_q = p["gtype"] == "full", q["gtype"] == "full"
    if full_p and full_q:
        # beside a misspelt surname the given name may have one slip
        if not same_given(p["given"], q["given"], known, 2 if dist == 0 else 1):
            return None
        return "same" if p["gen"] == q["gen"] else "stands" if not p["gen"] else "stood"
    if not p["given"] or not q["given"]:
        return "vague" if p["given"] == q["given"] and p["gen"] == q["gen"] else None
    fits = lambda short, long: any(f.startswith(short) for f in _formals(long))
    if full_p or full_q:
        short, long = (q, p) if full_p else (p, q)
        if not fits(short["given"], long["given"]) or short["gen"] and not long["gen"]:
            return None
        return "stood" if full_p else "stands"
    if p["gen"] != q["gen"] or not (p["given"].startswith(q["given"]) or q["given"].startswith(p["given"])):
        return None
    return "vague"


def deletions(word: str, most: int = 2) -> set[str]:
    """The word with up to ``most`` letters left out."""
    out = front = {word}
    for _ in range(most):
        front = {w[:i] + w[i + 1 :] for w in front for i in range(len(w))}
        out = out | front
    return out


def learn_given(names: DataFrame) -> dict[str, int]:
    """Given names of the collection: words that stand first in far more names than last. Misspellings of a much
    commoner one (two edits at most) are left out."""

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = []
            for n in t["name"]:
                head, _, tail = plain(n or "").partition(",")
                ws = [w for w in _tokens(head) if w.rstrip(".") not in TITLES | DEGREES and w.rstrip(".") not in GENERATIONS]
                after = [w for w in _tokens(tail) if w.rstrip(".") not in DEGREES and w.rstrip(".") not in GENERATIONS]
                if is_business(ws + after):
                    continue
                if after and ws:
                    rows += [(after[0], 1), (ws[-1], -1)]
                elif len(ws) > 1:
                    rows += [(ws[0], 1), (ws[-1], -1)]
            yield pd.DataFrame([(w, s) for w, s in rows if len(w) > 2 and not w.endswith(".")], columns=["word", "side"])

    score = names.mapInPandas(ends, "word string, side int").groupBy("word").agg(F.sum("side").alias("score")).filter(F.col("score") >= GIVEN_LEAST)
    score = durable(score)

    def shortened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t["cut"] = [sorted(deletions(w)) for w in t["word"]]
            yield t.explode("cut")

    # words within two edits have a common form with two letters or fewer left out
    cut = score.mapInPandas(shortened, "word string, score bigint, cut string")
    rare = cut.select("cut", F.col("word").alias("b"), F.col("score").alias("few"))
    pairs = cut.join(rare, "cut").filter((F.col("score") >= 10 * F.col("few")) & (F.col("word") != F.col("b"))).select(F.col("word").alias("a"), "b").distinct()

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            yield t[edit_distance(t["a"].tolist(), t["b"].tolist(), 2) <= 2][["b"]]

    slips = pairs.mapInPandas(near, "b string").distinct()
    kept = score.join(slips, F.col("word") == F.col("b"), "left_anti").limit(GIVEN_MOST + 1).collect()
    if len(kept) > GIVEN_MOST:
        raise ValueError(f"more than {GIVEN_MOST} given names")
    return {r["word"]: int(r["score"]) for r in kept}


def link_names(mentions: DataFrame) -> DataFrame:
    """(ref, person): what each mention's reference is resolved to.

    ``mentions``: ref STRING, name STRING, contexts ARRAY<STRING>; a ref may have several names. A ref with a
    full name is resolved by it; else its short name must stand for one person, in all or in its contexts."""
    spark = mentions.sparkSession
    known = spark.sparkContext.broadcast(learn_given(mentions.select("name").distinct()))

    def read(names: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str | None, tuple] = {}
        for s in names:
            for n in s:
                if n not in cache:
                    cache[n] = read_name(n, known.value) or (None,) * len(_COLUMNS)
            yield pd.DataFrame([cache[n] for n in s], columns=_COLUMNS)
            if len(cache) > 200_000:
                cache.clear()

    node = F.concat_ws("|", "p.kind", "p.key", F.coalesce("p.given", F.lit("")), F.coalesce("p.gtype", F.lit("")), F.coalesce("p.middle", F.lit("")), F.coalesce("p.gen", F.lit("")), F.coalesce("p.rest", F.lit("")))
    parsed = mentions.withColumn("p", F.pandas_udf(read, PARTS)(F.col("name"))).filter("p.key IS NOT NULL").withColumn("node", node)
    parsed = durable(parsed.select("ref", "contexts", "node", "p"))
    nodes = durable(parsed.select("node", "p").dropDuplicates(["node"]).select("node", "p.*"))
    spread = nodes.withColumn("init", F.explode("inits")).drop("inits")
    near = similar_keys(spread.select("init", "key").distinct())
    side = lambda s: spread.select(F.col("init"), *[F.col(c).alias(f"{s}_{c}") for c in ("node", "kind", "key", "given", "gtype", "middle", "gen", "rest")])
    left, right = side("p"), side("q")
    same_key = left.join(right, (left["init"] == right["init"]) & (F.col("p_key") == F.col("q_key")) & (F.col("p_node") < F.col("q_node"))).drop("init").withColumn("dist", F.lit(0))
    other = near.join(left.withColumnRenamed("init", "i1"), (F.col("init") == F.col("i1")) & (F.col("a") == F.col("p_key"))).join(right.withColumnRenamed("init", "i2"), (F.col("init") == F.col("i2")) & (F.col("b") == F.col("q_key"))).drop("init", "i1", "i2", "a", "b")
    pairs = same_key.unionByName(other).filter(F.col("p_kind") == F.col("q_kind"))

    def relate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = []
            for r in t.to_dict("records"):
                p, q = ({c: r[f"{s}_{c}"] for c in ("kind", "given", "gtype", "middle", "gen", "rest")} for s in "pq")
                if how := relation(p, q, r["dist"], known.value):
                    rows.append((r["q_node"], r["p_node"], "stands", r["dist"]) if how == "stood" else (r["p_node"], r["q_node"], how, r["dist"]))
            yield pd.DataFrame(rows, columns=["x", "y", "how", "dist"])

    related = durable(pairs.mapInPandas(relate, "x string, y string, how string, dist int").distinct())
    # names declared for one reference are of one person where both are full
    full = (F.col("p.kind") == "org") | (F.col("p.gtype") == "full")
    mine = parsed.filter(full).groupBy("ref").agg(F.min("node").alias("first"), F.collect_set("node").alias("all")).filter(F.size("all") > 1)
    declared = mine.select(F.col("first").alias("x"), F.explode("all").alias("y")).filter("x <> y")
    stands = related.filter("how = 'stands'")
    # the nearest spelling decides which persons a short name may stand for
    best = stands.groupBy("x").agg(F.min("dist").alias("least"))
    stands = stands.join(best, "x").filter(F.col("dist") == F.col("least")).select("x", "y")
    short = stands.select("x").distinct()
    vague = related.filter("how = 'vague'").select("x", "y")
    vague = vague.join(short, "x", "left_anti").join(short.withColumnRenamed("x", "y"), "y", "left_anti")
    # a short name of a reference vouches for the surname: its full name is that of whom the short one stands for, if the rest agrees
    part = lambda s: nodes.select(F.col("node").alias(f"{s}_node"), *[F.col(c).alias(f"{s}_{c}") for c in ("kind", "given", "gtype", "middle", "gen", "rest")])
    other_names = parsed.filter(~full).select("ref", F.col("node").alias("x")).join(parsed.filter(full).select("ref", F.col("node").alias("p_node")), "ref").select("x", "p_node").distinct()
    vouched = other_names.join(stands.withColumnRenamed("y", "q_node"), "x").filter("p_node <> q_node").select("p_node", "q_node").distinct()
    vouched = vouched.join(part("p"), "p_node").join(part("q"), "q_node").withColumn("dist", F.lit(0)).mapInPandas(relate, "x string, y string, how string, dist int").filter("how = 'same'").select("x", "y")
    edges = related.filter("how = 'same'").select("x", "y").unionByName(declared).unionByName(vouched).unionByName(vague)
    grouped = connected_groups(edges, "x", "y")
    person = durable(nodes.select("node").join(grouped.withColumnRenamed("vertex", "node"), "node", "left").select("node", F.coalesce("group", "node").alias("person")))
    may = stands.join(person.select(F.col("node").alias("y"), "person"), "y").select(F.col("x").alias("node"), "person").distinct()
    count = may.groupBy("node").agg(F.count("*").alias("n"), F.first("person").alias("only"))
    settled = durable(person.join(count, "node", "left").select("node", F.when(F.col("n").isNull(), F.col("person")).when(F.col("n") == 1, F.col("only")).alias("person"), F.col("n").isNull().alias("own")))
    rows = parsed.select("ref", "contexts", "node", full.alias("full")).join(settled, "node")
    sure = durable(rows.filter("person IS NOT NULL").select("ref", "person", "contexts", "full").distinct())
    doubt = rows.filter("person IS NULL").select("ref", "node", F.explode("contexts").alias("context")).distinct()
    seen = sure.filter("full").select("person", F.explode("contexts").alias("context")).distinct()
    fit = doubt.join(may, "node").join(seen, ["person", "context"], "left_semi").select("ref", "node", "person").distinct()
    fit = fit.groupBy("ref", "node").agg(F.count("*").alias("n"), F.first("person").alias("person")).filter("n = 1")
    answers = sure.select("ref", "person", F.when(F.col("full"), 0).otherwise(1).alias("rank")).unionByName(fit.select("ref", "person", F.lit(2).alias("rank")))
    first = answers.groupBy("ref").agg(F.min("rank").alias("best"))
    return answers.join(first.withColumnRenamed("ref", "r"), (F.col("ref") == F.col("r")) & (F.col("rank") == F.col("best"))).select("ref", "person").distinct()
