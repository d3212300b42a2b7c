"""Postal addresses: parsing into components, and records that denote one location by sorted neighbourhoods."""

from __future__ import annotations

import re
import unicodedata
from collections import deque
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.graph import classes
from tallyweave.operators.skew import salted_join
from tallyweave.session import cut, ship, width

# Words for kinds of streets and their abbreviations, one class per kind.
KIND_WORDS = {
    "road": "road rd", "street": "street st str", "lane": "lane ln", "avenue": "avenue ave av ava avenida", "close": "close cl", "drive": "drive drv dr",
    "rue": "rue r rua", "boulevard": "boulevard boul bld bd bvd", "chemin": "chemin chem ch", "largo": "largo lg lgo", "travessa": "travessa trav tv",
    "tee": "tee", "tanav": "tanav tn t", "maantee": "maantee mnt", "puiestee": "puiestee pst", "jalan": "jalan jln jl", "lorong": "lorong lrg lor", "persiaran": "persiaran psn psrn", "lebuh": "lebuh lbh",
    "strasse": "strasse straat", "weg": "weg wg", "platz": "platz pl", "allee": "allee all", "laan": "laan", "kade": "kade kd",
}
# Endings of street names written in one word, longest first.
KIND_ENDINGS = (("strasse", "strasse"), ("straat", "strasse"), ("allee", "allee"), ("platz", "platz"), ("laan", "laan"), ("kade", "kade"), ("weg", "weg"), ("str", "strasse"), ("all", "allee"), ("wg", "weg"), ("pl", "platz"), ("ln", "laan"), ("kd", "kade"))
# Names and codes of countries.
COUNTRIES = {
    "DE": "germany deutschland de", "GB": "united kingdom|great britain|uk|gb|england", "FR": "france fr", "PT": "portugal pt", "NL": "netherlands nederland nl", "EE": "estonia eesti ee",
    "MY": "malaysia my", "ZA": "south africa|rsa|za", "GH": "ghana gh",
}
COUNTRY_NAMES = {name: code for code, names in COUNTRIES.items() for name in (names.split("|") if "|" in names else names.split())}
# Parts of an address inside or beside the building.
UNITS = re.compile(
    r"\b(?:(?:suite|unit|shop|flat|apt|room|ruum|block|blok|level|loja|gebaude|bat|bp|piso)(?:\.? |\.)[0-9a-z]{1,4}|\d+(?:st|nd|rd|th) floor|\d+\.? ?og|\d+e? ?(?:verd|etage)\.?|[ivx]+ korrus|c/o [a-z]+|\d+\.?o? esq\.?)(?![a-z0-9])"
)
POSTCODES = re.compile(r"(?<![a-z0-9])(?:[a-z]{2}\d{2} ?\d[a-z]{2}|[a-z]{1,2}-\d{5}|\d{5}|\d{4}-\d{3}|\d{7}|\d{4} ?[a-z]{2}|\d{4})(?![a-z0-9])")
NUMBER = re.compile(r"(?<![a-z0-9])(?:(?:no|n|lot|hnr|nr)[. ]*)?(\d{1,4})(?:([a-z])|[ -]([a-h]))?(?![a-z0-9.])")
KINDS = {word: kind for kind, words in KIND_WORDS.items() for word in words.split()}
LOOKALIKES = str.maketrans("01580", "oisbo")


class Address(NamedTuple):
    """Components in folded letters; '' where missing."""

    street: str
    kind: str
    number: str
    town: str
    postcode: str
    country: str


def fold(text: str) -> str:
    """Lower-case letters without accents, white space as single blanks."""
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("º", "o").replace("ª", "a").replace("ø", "o"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def osa(a: str, b: str, most: int) -> int:
    """Edit distance in which swapping two neighbours counts as one edit; most + 1 if it is greater than `most`."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row, older = row, [i], before
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before = last
    return min(row[-1], most + 1)


def parse(text: str) -> Address:
    """Components of one address in any order and notation.

    Addressees, floors and units are left out. Country, postcode and house number are found by their forms, the kind of street by
    its word or ending, the street's name beside its kind, the town among what is left.
    """
    s = fold(text)
    s = re.sub(r"[\n\r\t;|,()]+| - ", " , ", s)
    s = re.sub(r"\b(?:no|n)\.?o ?(?=\d)", "no ", s)  # n.º 71, nº71
    s = " ".join(s.split())
    s = UNITS.sub(" , ", s)
    country = ""
    parts = [p.strip(" .-") for p in s.split(" , ")]
    parts = [p.strip(" ,.-") for p in parts if p.strip(" ,.-")]
    for at in (-1, 0):
        if parts and not country:
            words = parts[at].split()
            for n in (2, 1):
                edge = " ".join(words[-n:] if at else words[:n])
                if edge in COUNTRY_NAMES and (len(words) > n or len(parts) > 1):
                    if not at and len(words) > n and len(edge) == 2:
                        continue
                    country = COUNTRY_NAMES[edge]
                    rest = " ".join(words[:-n] if at else words[n:]).strip(" .-")
                    parts = [*parts[:-1], rest] if at else [rest, *parts[1:]]
                    parts = [p for p in parts if p]
                    break
    s = " , ".join(parts)
    postcode = ""
    m = list(POSTCODES.finditer(s))
    if m:
        best = max(m, key=lambda x: (len(re.sub(r"[^a-z0-9]", "", x[0])), x.start()))
        postcode = re.sub(r"^[a-z]{1,2}-(?=\d{5}$)|[ -](?=\d{3}$)|(?<=\d) (?=[a-z])", "", best[0])
        postcode = re.sub(r"[^a-z0-9]", "", postcode)
        s = s[: best.start()] + " , " + s[best.end() :]
    number, cutat = "", -1
    for m in NUMBER.finditer(s):
        number, cutat = m[1].lstrip("0") + (m[2] or m[3] or ""), m.start()
        s = s[: m.start()] + " # " + s[m.end() :]
        break
    tokens = [t for t in (re.sub(r"[^a-z0-9#,]", "", t) for t in re.sub(r"-(?=str|weg|pl|all|laan|kade|wg)", "", s).split()) if t]
    tokens = [t.translate(LOOKALIKES) if t.isalnum() and not t.isdigit() and t not in ("#", ",") else t for t in tokens]
    words = [(i, t) for i, t in enumerate(tokens) if t not in ("#", ",") and not t.isdigit()]
    street = kind = ""
    used: set[int] = set()
    hash_at = tokens.index("#") if "#" in tokens else None

    def near(i: int) -> int:
        return abs(i - hash_at) if hash_at is not None else 0

    found = [(near(i), i, KINDS[t]) for i, t in words if t in KINDS]
    if not found:
        ends = [(near(i), i, e, k) for i, t in words for e, k in KIND_ENDINGS if t.endswith(e) and len(t) > len(e) + 2]
        if ends:
            best_near = min(x[0] for x in ends)
            _, i, ending, kind = max((x for x in ends if x[0] == best_near), key=lambda x: len(x[2]))
            street, used = tokens[i][: -len(ending)], {i}
        else:
            near_kinds = [(near(i), i, KINDS[k]) for i, t in words if len(t) >= 4 for k in KINDS if len(k) >= 4 and osa(t, k, 1) <= 1]
            found = near_kinds[:1]
    if found and not used:
        _, i, kind = min(found)
        used = {i}
        before = i - 1 if i and tokens[i - 1] not in ("#", ",") and not tokens[i - 1].isdigit() else None
        after = i + 1 if i + 1 < len(tokens) and tokens[i + 1] not in ("#", ",") and not tokens[i + 1].isdigit() else None
        leads = kind in ("rue", "boulevard", "chemin", "largo", "travessa", "jalan", "lorong", "persiaran", "lebuh")
        if kind == "avenue":
            leads = before is None or tokens[i] == "avenida" or (after is not None and hash_at is not None and hash_at == i - 1)
        pick = (after if after is not None else before) if leads else (before if before is not None else after)
        if pick is not None:
            street, used = tokens[pick], {i, pick}
    rest = [(i, t) for i, t in words if i not in used and len(t) > 2]
    if not street and rest:
        i, street = min(rest, key=lambda x: (near(x[0]), x[0]))
        used.add(i)
        rest = [x for x in rest if x[0] != i]
    rest = [x for x in rest if x[1] not in COUNTRY_NAMES]
    town = max(rest, key=lambda x: (len(x[1]) > 3, x[0]))[1] if rest else ""
    return Address(street, kind, number, town, postcode, country)


PARTS = ("street", "kind", "number", "town", "postcode", "country")
# Kinds of streets by the language that uses them.
FAMILIES = {"en": "road street lane close drive", "romance": "rue boulevard chemin largo travessa", "ee": "tee tanav maantee puiestee", "my": "jalan lorong persiaran lebuh", "germanic": "strasse weg platz allee laan kade"}
FAMILY = {kind: family for family, kinds in FAMILIES.items() for kind in kinds.split()}


def parsed(records: DataFrame, batch: int = 20_000) -> DataFrame:
    """records (rec, address) with the components of each non-blank address: (rec, street, kind, number, town, postcode, country).

    Null and blank addresses give no row. Repeated texts of a batch are parsed once.
    """
    ship(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Address] = {}
        for b in batches:
            recs, out = [], []
            if len(seen) > batch:
                seen.clear()
            for rec, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text and text.strip():
                    if text not in seen:
                        seen[text] = parse(text)
                    recs.append(rec)
                    out.append(seen[text])
            yield pa.RecordBatch.from_arrays([pa.array(recs, b.column(0).type), *(pa.array([getattr(x, f) for x in out], pa.string()) for f in Address._fields)], names=["rec", *Address._fields])

    kind = records.schema["rec"].dataType.simpleString()
    return records.select("rec", "address").mapInArrow(run, f"rec {kind}, " + ", ".join(f"{f} string" for f in Address._fields))


def with_towns(df: DataFrame) -> DataFrame:
    """df with each town replaced by the one that most records of its postcode name, if it is missing or misspelt.

    Countries share postcodes; the language of the street's kind tells them apart (an avenue with five digits is a French one).
    """
    lookup = F.create_map(*(F.lit(x) for pair in FAMILY.items() for x in pair))
    df = df.withColumn("_family", F.when(F.col("kind") == "avenue", F.when(F.col("postcode").rlike("^[0-9]{5}$"), "romance").otherwise("en")).otherwise(F.coalesce(lookup[F.col("kind")], F.lit(""))))
    df = df.withColumn("_code", F.when(F.col("postcode") != "", F.concat_ws("|", "postcode", "_family")))
    named = df.where("_code is not null and town <> ''").groupBy("_code", "town").agg(F.count(F.lit(1)).alias("n"))
    usual = named.groupBy("_code").agg(F.max_by("town", F.struct("n", "town")).alias("usual"))
    near = F.levenshtein("town", "usual") <= F.greatest(F.lit(2), F.length("usual") / 4)
    return salted_join(df, usual, "_code", "left", spread=F.xxhash64("rec")).withColumn("town", F.when(F.col("usual").isNotNull() & ((F.col("town") == "") | near), F.col("usual")).otherwise(F.col("town"))).drop("usual", "_family", "_code")


def skeleton(word: str) -> str:
    """word with letter groups that scanners confuse made alike."""
    for group, letter in (("rn", "m"), ("cl", "d"), ("ri", "n"), ("vv", "w"), ("ii", "u")):
        word = word.replace(group, letter)
    return word


def alike(a: str, b: str, most: int) -> bool:
    """a and b are at most `most` edits or swaps apart, as they stand or with confused letters made alike."""
    return osa(a, b, most) <= most or osa(skeleton(a), skeleton(b), most) <= most


def same_location(a: tuple, b: tuple) -> bool:
    """Whether two (street, kind, number, town, postcode, country) denote one location.

    The house number with its letter must be equal and present, and so must the country where both name one. The kind of street must be equal where both have one. Streets may
    differ by one edit or swap (two, if long and in the same postcode or town), towns by one; a missing town is replaced by an equal
    postcode, and a town that agrees outweighs different postcodes only if the street is spelt alike.
    """
    if a[2] != b[2] or not a[2] or (a[1] and b[1] and a[1] != b[1]) or (a[5] and b[5] and a[5] != b[5]):
        return False
    street, other, code, code2 = a[0], b[0], a[4], b[4]
    same_code = bool(code) and code == code2
    if a[3] and b[3]:
        if a[3] != b[3] and not same_code and not (alike(a[3], b[3], 1) and not (code and code2)):
            return False
        if a[3] != b[3] and same_code and not alike(a[3], b[3], 2):
            return False
        if a[3] == b[3] and code and code2 and not same_code and osa(code, code2, 1) > 1 and street != other:
            return False
    elif not same_code:
        return False
    if not a[1] or not b[1]:
        street, other = street + a[1], other + b[1]
        if street == other or alike(a[0], b[0], 1):
            return True
    if street == other:
        return True
    if min(len(street), len(other)) < 4:
        return False
    return alike(street, other, 2 if (same_code or a[3] == b[3]) and min(len(street), len(other)) >= 7 else 1)


#: Component orders of the passes; a leading '-' reverses the letters. The first LEAD components and the next one's first letter make up a run.
PASSES, LEAD = (("number", "town", "street", "kind"), ("number", "street", "town", "postcode"), ("number", "postcode", "-street", "kind"), ("town", "-street", "number", "kind")), 2


def neighbours(reps: DataFrame, order: tuple[str, ...], window: int, tasks: int) -> DataFrame:
    """Links (a, b) of representatives (rep, *PARTS) that are neighbours in the order and denote one location.

    A row is compared with the `window` rows before it, and with all before it of its run: rows that agree in the first LEAD components and in the first
    letter of the next, so the window grows where a house number and town are dense. Rows are split into `tasks` ranges of the order and
    sorted there; each task slides over its range. The last rows of each range meet the first ones of the next in a task of their own for each border.
    """
    plain = [k.lstrip("-") for k in order]
    keys = [F.reverse(k[1:]) if k[0] == "-" else F.col(k) for k in order] + [F.col("rep")]
    fields = ["rep", *PARTS]
    at = [fields.index(k) for k in plain[: LEAD + 1]]

    def run_of(row: tuple) -> tuple:
        nxt = row[at[LEAD]]
        return (*(row[i] for i in at[:LEAD]), nxt[-1:] if order[LEAD][0] == "-" else nxt[:1])

    def compared(rows: Iterator[tuple], border: bool = False) -> Iterator[tuple[int, int]]:
        """Links among sorted rows; of a border (rows behind their side) only those from one side to the other."""
        last: deque = deque()
        mine = None
        for row in rows:
            if border:
                side, row = row[0], row[1:]
            key = run_of(row)
            mine = mine if mine and mine[0] == key else [key, 0]
            while len(last) > max(window, mine[1]):
                last.popleft()
            for other in last:
                if border and other[0] == side:
                    continue
                them = other[1:] if border else other
                if same_location(row[1:], them[1:]):
                    yield min(row[0], them[0]), max(row[0], them[0])
            last.append((side, *row) if border else row)
            mine[1] += 1

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        head: list[tuple] = []
        tail: deque = deque()
        state = {"open": True, "run": None, "n": 0}

        def rows() -> Iterator[tuple]:
            for b in batches:
                for row in zip(*(b.column(i).to_pylist() for i in range(len(fields)))):
                    key = run_of(row)
                    state["n"] = state["n"] + 1 if key == state["run"] else 1
                    state["run"] = key
                    if len(head) < window or run_of(head[0]) == key and len(head) == state["n"] - 1:
                        head.append(row)
                    tail.append(row)
                    while len(tail) > max(window, state["n"]):
                        tail.popleft()
                    yield row

        found: list[tuple[int, int]] = []
        for pair in compared(rows()):
            found.append(pair)
            if len(found) == 10_000:
                yield out_of(found, [])
                found = []
        yield out_of(found, [(here, 1, *r) for r in tail] + [(here - 1, 2, *r) for r in head])

    def out_of(links: list[tuple[int, int]], edge: list[tuple]) -> pa.RecordBatch:
        n, m = len(links), len(edge)
        cols = [pa.array([x for x, _ in links] + [None] * m, pa.int64()), pa.array([y for _, y in links] + [None] * m, pa.int64())]
        cols += [pa.array([None] * n + [e[i] for e in edge], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), *(pa.string() for _ in PARTS)))]
        return pa.RecordBatch.from_arrays(cols, names=["a", "b", "border", "side", *fields])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(2 + len(fields)))))
        found = [pair for _, own in groupby(rows, lambda r: r[0]) for pair in compared((r[1:] for r in own), True)]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    ship(reps.sparkSession)
    ranged = reps.select(*fields).repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    out = ranged.mapInArrow(slide, "a long, b long, border int, side int, rep long, " + ", ".join(f"{f} string" for f in PARTS))
    if tasks == 1:
        return out.where("b is not null").select("a", "b")
    out = cut(out)
    edges = out.where("b is null").select("border", "side", *fields).repartition("border").sortWithinPartitions("border", "side", *keys)
    return out.where("b is not null").select("a", "b").unionByName(edges.mapInArrow(across, "a long, b long"))


def locations(records: DataFrame, window: int = 12, per_task: int = 2_000) -> DataFrame:
    """records (rec, address) -> (rec, location): records of one location share it.

    Records whose components are equal are one representative; multi-pass sorted neighbourhoods link representatives, and linked
    ones are one location. Null and blank addresses give no row; those without a street, a house number or any of town and postcode
    ('n/a', 'Hauptstr., Berlin') denote no certain place: their location is null. Repeated rows share theirs. Copies never enter a window, so
    a location that holds any share of the rows costs no more than its spellings.
    """
    rows = with_towns(cut(parsed(records)))
    certain = (F.col("street") != "") & (F.col("number") != "") & ((F.col("town") != "") | (F.col("postcode") != ""))
    rows = cut(rows.select("rec", F.when(certain, F.xxhash64(*PARTS)).alias("rep"), *PARTS))
    reps = cut(rows.where("rep is not null").groupBy("rep").agg(*(F.first(p).alias(p) for p in PARTS)))
    links, tasks = None, max(1, min(width(reps) * 4, reps.count() // per_task))
    for order in PASSES:
        found = neighbours(reps, order, window, tasks)
        links = found if links is None else links.unionByName(found)
    member = classes(links.distinct())
    member = member.select(F.col("node").alias("rep"), "label")
    return salted_join(rows.select("rec", "rep"), member, "rep", "left", spread=F.xxhash64("rec")).select("rec", F.coalesce("label", "rep").alias("location"))


def location_pairs(records: DataFrame, window: int = 12) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b: all pairs of records of one location, repeated rows included; a hot location's rows are salted."""
    at = cut(locations(records, window).where("location is not null"))
    other = at.select(F.col("rec").alias("rec_b"), "location")
    pairs = salted_join(at.withColumnRenamed("rec", "rec_a"), other, "location", "inner", spread=F.xxhash64("rec_a"))
    return pairs.where("rec_a < rec_b").select("rec_a", "rec_b")
