"""Variant spellings of typed names: which user ids stand for the same person or organisation.

A typed name is read as family and given name (an organisation as stem and type); one of two words without comma also the other way
round if its first word is the rarer one. Both parts become unit vectors of TF-IDF weighted character n-grams, and the cosine of two
names is the mean of the cosines of their parts, the best over their readings. The n-grams of a family are tagged with the initial of
the given name, so the members of a large family meet only where they can be one person. A distributed sparse join with prefix
filtering finds the families (exact: no partner above the threshold is lost and none is capped), the given names follow. Names that
differ by more than slips (family or given name), or whose middle initials contradict each other, are no candidates. Average-linkage
clustering on the cosines, in rounds of reciprocal nearest neighbours, groups the names. Reciprocal merging gives the same clusters as
merging the closest pair each time, but needs no cluster to be held in one task.

Every distinct reading is kept once however many users typed it. No list of given or family names is used; the table of short forms
(Bill for William) is a parameter.

Defined results: null, blank and place-holder names stand for nobody; users without a name have no links; equal names link their users;
a user with several names links those; a single word longer than ``LONGEST`` letters is not taken apart; empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.components import components
from commitlake.session import cut, keep

#: Cosine from which two names are linked, and average cosine from which two clusters are merged.
COSINE = 0.62
#: Cosine of two family names below which no given name makes up for it.
FAMILY = 0.38
#: Share of a given name's vector that its initial has (all of it, if it is but an initial).
INITIAL = 0.5
#: Cosine from which two names support a class they may share; below it they count as strangers.
SUPPORT = 0.45
#: Letters of a single word that may be two names run together.
LONGEST = 64

# Short forms of given names with the full names they stand for.
SHORT_FORMS = {
    "alex": "alexander aleksandra", "alek": "aleksandra alexander", "sasha": "alexander aleksandra", "xander": "alexander", "sandy": "alexander aleksandra",
    "ola": "aleksandra oluwaseun", "seun": "oluwaseun", "kate": "katherine", "katie": "katherine", "kathy": "katherine", "kit": "katherine christopher",
    "kitty": "katherine", "kat": "katherine", "cathy": "katherine", "katya": "yekaterina", "katia": "yekaterina", "rob": "robert", "robbie": "robert", "bob": "robert", "bobby": "robert",
    "bert": "robert", "bill": "william", "billy": "william", "will": "william", "willy": "william", "liam": "william", "mike": "michael", "mick": "michael", "mickey": "michael",
    "meg": "margaret", "maggie": "margaret", "peggy": "margaret", "peg": "margaret", "greta": "margaret", "madge": "margaret", "tom": "thomas", "tommy": "thomas",
    "liz": "elizabeth", "lizzy": "elizabeth", "beth": "elizabeth", "eliza": "elizabeth", "betty": "elizabeth", "betsy": "elizabeth", "chris": "christopher", "topher": "christopher",
    "jon": "jonathan", "jonny": "jonathan", "nathan": "jonathan", "nick": "nicholas", "nico": "nicholas", "nicky": "nicholas", "gabi": "gabriela", "gaby": "gabriela",
    "nacho": "ignacio", "paca": "francisca", "paquita": "francisca", "fran": "francisca", "ted": "theodore edward", "teddy": "theodore edward", "theo": "theodore", "ben": "benjamin", "benny": "benjamin", "benji": "benjamin",
    "mina": "wilhelmina", "willa": "wilhelmina", "minnie": "wilhelmina", "dima": "dmitri", "mitya": "dmitri", "henk": "henrik", "rik": "henrik", "hank": "henrik", "leo": "leonardo", "leon": "leonardo",
    "slava": "stanislav", "stas": "stanislav", "stan": "stanislav", "hannes": "johannes", "jo": "johannes", "hans": "johannes", "sue": "susanna", "sanna": "susanna", "susie": "susanna", "suzy": "susanna",
    "vicky": "victoria", "vicki": "victoria", "tori": "victoria", "pat": "patricia", "patty": "patricia", "trish": "patricia", "tricia": "patricia", "matt": "matthias", "matz": "matthias",
    "zach": "zacharias", "zack": "zacharias", "fred": "frederick", "freddy": "frederick", "freddie": "frederick", "rick": "frederick", "sam": "samantha", "sammy": "samantha", "tim": "timothy", "timmy": "timothy",
    "ed": "edward", "eddie": "edward", "ned": "edward", "magda": "magdalena", "lena": "magdalena", "becky": "rebecca", "becca": "rebecca", "tadek": "tadeusz", "tad": "tadeusz",
    "seb": "sebastian", "basti": "sebastian", "bastian": "sebastian", "harry": "harold", "hal": "harold", "greg": "gregory", "vince": "vincent", "vinnie": "vincent", "uli": "ulrike", "ulla": "ulrike",
    "jackie": "jacqueline", "priya": "priyanka", "zuzka": "zuzana", "zuza": "zuzana", "lubo": "lubomir", "ron": "ronald", "dan": "daniel", "danny": "daniel", "dave": "david", "jim": "james",
    "jimmy": "james", "joe": "joseph", "andy": "andrew", "drew": "andrew", "tony": "anthony", "steve": "stephen", "jen": "jennifer", "jenny": "jennifer", "kim": "kimberly", "ken": "kenneth",
}

# What kind of organisation a word names, with its abbreviations.
ORGANISATIONS = {
    "foundation": "fdn found", "engineering": "eng engg", "networks": "net network nets", "robotics": "robo", "software": "sw soft", "technologies": "tech technology techs",
    "laboratories": "labs lab laboratory", "institute": "inst", "systems": "sys system", "collective": "coll", "group": "grp", "solutions": "sol", "consulting": "cons",
    "industries": "ind", "association": "assoc", "university": "univ", "project": "proj", "studios": "studio", "services": "svc",
}
# Words around a name that are no part of it.
LEGAL = frozenset("inc ltd gmbh llc corp co ag plc sa bv ab oy limited incorporated".split())
TITLES = frozenset("dr prof mr mrs ms phd md msc bsc jr sr ing".split())
# Names that stand for nobody.
PLACEHOLDERS = frozenset(
    "root admin administrator ubuntu jenkins test tester unknown user username your-name no-author none null nobody anonymous n-a guest default dev developer "
    "git github ci build builder bot travis localhost system me author committer vagrant docker nil undefined name first-last john-doe jane-doe somebody".split()
)

_ORG = {w: k for k, v in ORGANISATIONS.items() for w in [k, *v.split()]}
_ORG_TAIL = re.compile(r"^(.{4,}?)(" + "|".join(sorted(_ORG, key=len, reverse=True)) + r")$")
_DECORATION = re.compile(r"\bvia\s+(?:web|app|mobile|e?mail|\w+\s+web)\b|\bbuild\s+account\b|\bservice\s+account\b|\(([^()]*)\)|\[[^\[\]]*\]")
_QUOTED = re.compile(r"(?<=\S)\s+[\"“”'‘’(][^\"“”'‘’()]+[\"“”'‘’)]\s+(?=\S)")
_SPECIAL = str.maketrans({"ß": "ss", "ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ı": "i"})


def fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().translate(_SPECIAL)) if not unicodedata.combining(c))


READING = ["kind", "family", "given", "middle"]


def readings(typed: str) -> list[tuple[str, str, str, str]]:
    """The readings ``(kind, family, given, middle)`` of a typed name, the usual one first; none for a place-holder.

    ``kind``: ``person``, ``org`` (family its stem, given its type) or ``word`` (a single word that may hide a name).
    """
    if re.search(r"\[bot\]|\bbot\b", typed.lower()):
        return []
    text = _QUOTED.sub(" ", _DECORATION.sub(" ", fold(typed)))
    text = re.sub(r"[\"“”‘’`]|(?<!\w)'|'(?!\w)", " ", text)
    words = re.findall(r"[^\W\d_]+", text.replace("'", ""))
    if not words or "-".join(words) in PLACEHOLDERS:
        return []
    words = [w for w in words if w not in TITLES or len(words) == 1]
    core = [w for w in words if w not in LEGAL and w != "the"] or words
    types = [w for w in core if w in _ORG]
    if types and len(core) >= 2:
        stem = [w for w in core if w != types[-1]]
        out = [("org", "".join(stem), _ORG[types[-1]], "")] if stem else []
        if len(core) == 2 and len(types[-1]) <= 3:  # a short word may as well be a name
            out += [("person", core[0], core[1], ""), ("person", core[1], core[0], "")]
        return out
    before, comma, after = text.partition(",")
    if comma:
        family, given = ([w for w in re.findall(r"[^\W\d_]+", part) if w not in TITLES] for part in (before, after))
        if family and given:
            first = next((w for w in given if len(w) > 1), given[0])
            return [("person", "".join(family), first, next((w for w in given if len(w) == 1 and w != first), ""))]
    long_, single = [w for w in words if len(w) > 1], [w for w in words if len(w) == 1]
    if len(long_) >= 2:
        middle = single[0] if single else ""
        return [("person", "".join(long_[1:]), long_[0], middle), ("person", "".join(long_[:-1]), long_[-1], middle)]
    if len(long_) == 1 and single:
        return [("person", long_[0], single[0], single[1] if len(single) > 1 else "")]
    if not long_:
        return [("word", "".join(words), "", "")] if words else []
    tail = _ORG_TAIL.match(long_[0])
    return [("word", long_[0], "", "")] + ([("org", tail[1], _ORG[tail[2]], "")] if tail else [])


def distance(a: str, b: str, most: int = 2) -> int:
    """Edits between two words (insert, delete, replace, swap of neighbours); above ``most`` it stops counting."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
        if min(row) > most:
            return most + 1
    return last[-1]


def slips(a: str, b: str) -> int:
    """Edits by which one word may be the other, mistyped: two at most, fewer in short words; -1 if it can't be."""
    shorter, edits = min(len(a), len(b)), distance(a, b)
    return edits if edits <= (0 if shorter < 4 else 1 if shorter < 6 else 2) else -1


def name_readings(names: DataFrame) -> DataFrame:
    """``value, kind, family, given, middle``: the readings that count of each distinct typed name that stands for somebody.

    The second order of a name counts if its first word is the rarer one among all names; a single word counts as the names it can be
    cut into (with both parts, or the part beside an initial, known from other names), else as itself.
    """

    def read_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(v, k, *r) for v in batch["value"] for k, r in enumerate(readings(v))]
            yield pd.DataFrame(rows, columns=["value", "choice", *READING])

    read_ = cut(names.select("value").distinct().mapInPandas(read_all, "value string, choice int, kind string, family string, given string, middle string"))
    persons = read_.filter("kind = 'person'")
    known = cut(persons.select("value", F.explode(F.array("family", "given")).alias("word")).distinct().groupBy("word").agg(F.count("*").alias("n")))
    of = lambda c: known.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    doubtful = read_.filter("choice > 0 and kind = 'person'")
    turned = doubtful.join(of("family"), "family").join(of("given"), "given").filter("n_family < n_given").select("value", *READING)
    words = read_.filter("kind = 'word'").select("value", F.col("family").alias("word"))
    cuts = words.filter(F.length("word").between(5, LONGEST)).select("value", "word", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at"))
    cuts = cuts.select("value", F.substring("word", F.lit(1), F.col("at")).alias("left"), F.substring("word", F.col("at") + 1, F.length("word")).alias("right"))
    whole = known.select("word").withColumn("is", F.lit(True))
    for side in ("left", "right"):
        cuts = cuts.join(whole.withColumnsRenamed({"word": side, "is": f"{side}_known"}), side, "left").withColumn(f"{side}_known", F.coalesce(f"{side}_known", F.lit(False)) | (F.length(side) == 1))
    cuts = cuts.filter((F.col("left_known") & F.col("right_known")) & (F.greatest(F.length("left"), F.length("right")) >= 4))
    parts = F.explode(F.array(F.struct(F.col("left").alias("given"), F.col("right").alias("family")), F.struct(F.col("right").alias("given"), F.col("left").alias("family"))))
    split = cuts.select("value", parts.alias("p")).select("value", F.lit("person").alias("kind"), "p.family", "p.given", F.lit("").alias("middle")).filter("length(family) > 1")
    sure = read_.filter("kind <> 'word' and (choice = 0 or kind = 'org')").select("value", *READING)
    return sure.unionByName(turned).unionByName(split).unionByName(read_.filter("kind = 'word'").select("value", *READING)).distinct()


def grams(word: str) -> Counter:
    """Character n-grams of a word between marks: three letters in order, and two letters next to or nearly next to each other in any
    order, which a swap of neighbours leaves alone."""
    w = f"^{word}$"
    near = [w[i : i + 3] for i in range(len(w) - 2)] + ["".join(sorted(w[i : i + 2])) for i in range(len(w) - 1)]
    return Counter(near + ["".join(sorted((w[i], w[i + 2]))) + "_" for i in range(len(w) - 2)])


def vectors(words: DataFrame) -> DataFrame:
    """``id, gram, weight, df``: unit vectors of TF-IDF weighted n-grams of ``id, tag, word``; n-grams of different tags are different."""

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = [(i, f"{tag}:{g}", n) for i, tag, word in zip(t["id"], t["tag"], t["word"]) for g, n in grams(word).items()]
            yield pd.DataFrame(rows, columns=["id", "gram", "tf"])

    terms = cut(words.select("id", "tag", "word").mapInPandas(spell, "id string, gram string, tf int"))
    df = terms.groupBy("gram").agg(F.count("*").alias("df"))
    n = float(words.count())
    weighted = terms.join(df, "gram").withColumn("w", F.sqrt("tf") * F.log(1 + F.lit(n) / F.col("df")))
    norm = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return cut(weighted.join(norm, "id").select("id", "gram", (F.col("w") / F.col("norm")).alias("weight"), "df"))


def cosines(pairs: DataFrame, vecs: DataFrame) -> DataFrame:
    """``a, b, cosine`` of the pairs that share any n-gram."""
    one = lambda side: vecs.select(F.col("id").alias(side), "gram", F.col("weight").alias(f"w{side}"))
    return pairs.join(one("a"), "a").join(one("b"), ["b", "gram"]).groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine"))


def similar_families(vecs: DataFrame, threshold: float = FAMILY) -> DataFrame:
    """``a, b, cosine, edits`` (a < b) of the families, as ``tag|word``, with a cosine of at least the threshold that differ by slips only.

    Prefix filter: ordered from frequent to rare, the n-grams of a vector are left out of the index as long as together they weigh less
    than the threshold. If two vectors shared only n-grams left out of one of them, their cosine would be below the threshold; so every
    pair shares one that both index, and frequent n-grams hardly ever key the join. Pairs whose lengths and letters differ by more than
    slips are dropped inside the join.
    """
    order = Window.partitionBy("id").orderBy(F.col("df").desc(), "gram")
    rest = F.sum(F.col("weight") * F.col("weight")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    prefix = cut(vecs.withColumn("rest", rest).filter(F.col("rest") >= threshold * threshold).select("gram", "id", F.substring_index("id", "|", -1).alias("word")))
    left, right = prefix.withColumnsRenamed({"id": "a", "word": "wa"}), prefix.withColumnsRenamed({"id": "b", "word": "wb"})
    near = (F.abs(F.length("wa") - F.length("wb")) <= 2) & (F.levenshtein("wa", "wb", 4) >= 0)
    pairs = left.join(right, "gram").filter((F.col("a") < F.col("b")) & near).select("a", "b", "wa", "wb").distinct()

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            edits = [slips(x, y) for x, y in zip(t["wa"], t["wb"])]
            yield t[["a", "b"]].assign(edits=edits)[[e >= 0 for e in edits]]

    checked = cut(pairs.mapInPandas(check, "a string, b string, edits int"))
    return cosines(checked.select("a", "b"), vecs).filter(F.col("cosine") >= threshold).join(checked, ["a", "b"])


def given_names(pairs: DataFrame, vecs: DataFrame) -> DataFrame:
    """``a, b, cosine, edits`` of the pairs of whole given names, as ``tag|word``, that differ by slips only."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            edits = [slips(x.split("|")[1], y.split("|")[1]) for x, y in zip(t["a"], t["b"])]
            yield t[["a", "b"]].assign(edits=edits)[[e >= 0 for e in edits]]

    checked = cut(pairs.mapInPandas(check, "a string, b string, edits int"))
    return cosines(checked.select("a", "b"), vecs).join(checked, ["a", "b"])


def linked_names(read_: DataFrame, short_forms: dict[str, str] | None = None, threshold: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """``(of_value, pairs)``: each value's ``unit`` (values of the same readings are one) and the unit pairs ``a, b, score``."""
    full = {k: v.split() for k, v in (SHORT_FORMS if short_forms is None else short_forms).items()}
    node = F.concat_ws("|", "kind", "family", "given")
    read_ = read_.withColumn("node", node)
    of_value = cut(read_.groupBy("value").agg(F.concat_ws("/", F.array_sort(F.collect_set(F.concat_ws("|", "node", "middle")))).alias("unit"), F.max("middle").alias("middle")))
    of_node = cut(read_.select("value", "node").join(of_value.select("value", "unit", "middle"), "value").select("unit", "node", "middle").distinct())

    def options(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each given name with all it may be short for."""
        for t in batches:
            rows = [(n, k, f, g) for n, k, f, given in zip(t["node"], t["kind"], t["family"], t["given"]) for g in (full.get(given, [given]) if k == "person" else [given])]
            yield pd.DataFrame(rows, columns=["node", "kind", "family", "given"])

    nodes = read_.filter("kind <> 'word' and given <> ''").select("node", "kind", "family", "given").distinct()
    tag = F.concat(F.substring("kind", 1, 1), F.substring("given", 1, 1))
    nodes = cut(nodes.mapInPandas(options, "node string, kind string, family string, given string").withColumns({"fam": F.concat_ws("|", tag, "family"), "giv": F.concat_ws("|", F.substring("kind", 1, 1), "given")}))
    families = nodes.select(F.col("fam").alias("id"), F.substring_index("fam", "|", 1).alias("tag"), F.col("family").alias("word")).distinct()
    near = similar_families(vectors(families))
    near = cut(near.unionByName(families.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("cosine"), F.lit(0).alias("edits"))))
    one = lambda s: nodes.select(F.col("fam").alias(s), F.col("node").alias(f"n{s}"), F.col("giv").alias(f"g{s}"))
    met = cut(near.join(one("a"), "a").join(one("b"), "b").filter("na <> nb and (a <> b or na < nb)").select("na", "nb", "ga", "gb", "cosine", "edits"))
    # cosines of the given names that meet; equal ones need none
    given = nodes.select(F.col("giv").alias("id"), F.substring("kind", 1, 1).alias("tag"), F.col("given").alias("word")).filter("length(word) > 1").distinct()
    asked = met.filter("ga <> gb").select(F.col("ga").alias("a"), F.col("gb").alias("b")).distinct()
    like = given_names(asked, vectors(given)).withColumnsRenamed({"a": "ga", "b": "gb", "cosine": "like", "edits": "more"})
    initial = lambda c: F.length(F.substring_index(c, "|", -1)) == 1
    given_cosine = F.when(F.col("ga") == F.col("gb"), 1.0).when(initial("ga") | initial("gb"), INITIAL**0.5).otherwise(INITIAL + (1 - INITIAL) * F.col("like"))
    mean, edits = (F.col("cosine") + given_cosine) / 2, F.col("edits") + F.coalesce("more", F.lit(0))
    # names two slips apart support a class but make none
    scored = met.join(like, ["ga", "gb"], "left").withColumn("score", F.when(edits <= 1, mean).otherwise(F.least(mean, F.lit(0.9 * threshold))))
    scored = scored.filter((F.col("score") >= SUPPORT) & (edits <= 2))
    scored = scored.groupBy(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).agg(F.max("score").alias("score"))
    # from readings to names: the best readings count
    unit = lambda s: of_node.select(F.col("node").alias(s), F.col("unit").alias(f"u{s}"), F.col("middle").alias(f"m{s}"))
    equal = unit("a").join(unit("b"), F.col("a") == F.col("b")).select("ua", "ub", "ma", "mb", F.lit(1.0).alias("score"))
    pairs = scored.join(unit("a"), "a").join(unit("b"), "b").select("ua", "ub", "ma", "mb", "score").unionByName(equal)
    pairs = pairs.filter("ua <> ub and (ma = '' or mb = '' or ma = mb)")
    return of_value.select("value", "unit"), cut(pairs.groupBy(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).agg(F.max("score").alias("score")))


def average_linkage(nodes: DataFrame, pairs: DataFrame, threshold: float = COSINE) -> DataFrame:
    """``node, cluster`` by average linkage over scored pairs (pairs not listed score 0), in rounds of reciprocal nearest neighbours."""
    member = keep(nodes.select("node", F.col("node").alias("cluster")))
    links = keep(pairs.select("a", "b", F.col("score").alias("total")))
    sizes = None
    while True:
        if sizes is None:
            means = links.withColumn("mean", F.col("total"))
        else:
            means = links.join(sizes.select(F.col("cluster").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("cluster").alias("b"), F.col("n").alias("nb")), "b")
            means = means.withColumn("mean", F.col("total") / (F.col("na") * F.col("nb")))
        near = means.filter(F.col("mean") >= threshold).withColumn("rank", F.struct("mean", F.xxhash64("a", "b").alias("h")))
        ends = near.select(F.col("a").alias("c"), "a", "b", "rank").unionByName(near.select(F.col("b").alias("c"), "a", "b", "rank"))
        nearest = ends.groupBy("c").agg(F.max_by(F.struct("a", "b"), "rank").alias("p"))
        merges = keep(nearest.groupBy("p").agg(F.count("*").alias("both")).filter("both = 2").select(F.col("p.b").alias("old"), F.col("p.a").alias("new")))
        if not merges.limit(1).count():
            return member
        member = keep(member.join(merges.withColumnRenamed("old", "cluster"), "cluster", "left").select("node", F.coalesce("new", "cluster").alias("cluster")))
        moved = links.join(merges.select(F.col("old").alias("a"), F.col("new").alias("na")), "a", "left").join(merges.select(F.col("old").alias("b"), F.col("new").alias("nb")), "b", "left")
        moved = moved.select(F.coalesce("na", "a").alias("x"), F.coalesce("nb", "b").alias("y"), "total").filter("x <> y")
        links = keep(moved.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("total").alias("total")))
        sizes = member.groupBy("cluster").agg(F.count("*").alias("n"))


def typed_names(users_metadata: DataFrame) -> DataFrame:
    """``user_id, value``: every non-blank name a user was recorded with."""
    return users_metadata.filter("key = 'name' and id is not null and trim(value) <> ''").select(F.col("id").cast("long").alias("user_id"), F.trim("value").alias("value")).distinct()


def linked_users(users_metadata: DataFrame, short_forms: dict[str, str] | None = None) -> DataFrame:
    """``user_id, cluster``: the users whose typed names stand for somebody, with the class of names they belong to."""
    names = cut(typed_names(users_metadata))
    of_value, pairs = linked_names(cut(name_readings(names)), short_forms)
    clusters = average_linkage(of_value.select(F.col("unit").alias("node")).distinct(), pairs)
    found = cut(names.join(of_value, "value").join(clusters.withColumnRenamed("node", "unit"), "unit").select("user_id", F.xxhash64("cluster").alias("cluster")).distinct())
    # the names of one user stand for one: its classes are one class, whatever their names look like
    following = found.withColumn("next", F.lead("cluster").over(Window.partitionBy("user_id").orderBy("cluster"))).filter("next is not null")
    united = components(following.select(F.col("cluster").alias("a"), F.col("next").alias("b")))
    return found.join(united.withColumnRenamed("node", "cluster"), "cluster", "left").select("user_id", F.coalesce("leader", "cluster").alias("cluster")).distinct()


def same_pairs(linked: DataFrame) -> DataFrame:
    """``user_id_1, user_id_2`` of different users of one class, smaller first."""
    return (
        linked.select(F.col("user_id").alias("user_id_1"), "cluster")
        .join(linked.select(F.col("user_id").alias("user_id_2"), "cluster"), "cluster")
        .filter("user_id_1 < user_id_2").select("user_id_1", "user_id_2").distinct()
    )
