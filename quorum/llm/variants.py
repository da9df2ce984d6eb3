"""Records that name the same person under variant spellings.

Surnames of one locality are joined within two edits by metric-space partitioning; an exact check of the given
names (vocabulary, relations, initials) and of shared contacts follows. Equal names of a locality are one
class and are compared once; links between classes are consolidated into persons at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm import components, metric, names
from quorum.session import cut

RADIUS = 2
#: a contact used by more surnames than this that are no spellings of each other is a placeholder: it is no one's own
UNRELATED = 3
#: a spelling this much rarer than another two edits away is its misspelling
TIMES = 4
GIVEN = ["forms", "wider", "letters", "stems", "rare", "initial"]


def snapped_places(parts: DataFrame) -> DataFrame:
    """parts with misspelled places of a state replaced by the frequent place that they are near to."""
    places = metric.snap_to_frequent(parts.groupBy(F.col("state").alias("grp"), F.col("place").alias("name")).agg(F.count(F.lit(1)).alias("n")), RADIUS)
    return parts.join(places.select(F.col("grp").alias("state"), F.col("name").alias("place"), "snapped"), ["state", "place"]).withColumn("place", F.col("snapped")).drop("snapped")


def placeholders(parts: DataFrame) -> DataFrame:
    """contact: the e-mail addresses and phone numbers in use under more than UNRELATED surnames, spellings of one surname counting as one.

    The spellings under one contact are joined within the radius; counted are those that are near to no lesser one.
    """
    used = cut(parts.where(F.col("surname") != "").select("surname", F.explode(F.array_compact(F.array("email", "phone"))).alias("contact")).distinct())
    n = used.groupBy("contact").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > UNRELATED)
    spellings = cut(used.join(n, "contact").select(F.col("contact").alias("grp"), F.col("surname").alias("name"), "n"))
    near = metric.radius_join(spellings.select("grp", "name"), RADIUS)
    more = near.groupBy("grp").agg(F.countDistinct("name_b").alias("repeats"))
    return n.withColumnRenamed("contact", "grp").join(more, "grp", "left").where(F.col("n") - F.coalesce("repeats", F.lit(0)) > UNRELATED).select(F.col("grp").alias("contact"))


def contacts(parts: DataFrame, key: str) -> DataFrame:
    """key, contact: the e-mail addresses and phone numbers but for placeholders."""
    both = parts.select(key, F.explode(F.array_compact(F.array("email", "phone"))).alias("contact")).distinct()
    return both.join(placeholders(parts), "contact", "left_anti").select(key, "contact")


def one_edit(x: Column, y: Column) -> Column:
    return (F.levenshtein(x, y, 1) >= 0) | transposed(x, y)


def given_level(a: str, b: str) -> Column:
    """How far the given names of two rows agree: 3 a common form, 2 related names, a short form or spellings of a rare name, 1 no more than initials, 0 not at all."""
    x = lambda s, c: F.col(f"{s}_{c}")
    typed = lambda s, t: F.exists(x(s, "rare"), lambda i: F.exists(x(t, "rare"), lambda f: (F.length(i) > 3) & (F.length(f) > 3) & one_edit(i, f)))
    begins = lambda s, t: F.exists(x(s, "stems"), lambda i: F.exists(x(t, "forms"), lambda f: f.startswith(i)))
    return (
        F.when(F.arrays_overlap(x(a, "forms"), x(b, "forms")), 3)
        .when(F.arrays_overlap(x(a, "forms"), x(b, "wider")) | F.arrays_overlap(x(b, "forms"), x(a, "wider")), 2)
        .when(begins(a, b) | begins(b, a) | typed(a, b), 2)
        .when((x(a, "initial") | x(b, "initial")) & F.arrays_overlap(x(a, "letters"), x(b, "letters")), 1)
        .otherwise(0)
    )


def transposed(x: Column, y: Column) -> Column:
    """Whether two words of one length differ in two neighbouring letters that are exchanged."""
    chars = F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: F.when(p != q, F.concat(p, q)))
    odd = F.array_compact(chars)
    return (F.length(x) == F.length(y)) & (F.size(odd) == 2) & (F.get(odd, F.lit(0)) == F.reverse(F.get(odd, F.lit(1))))


def related_rest(pairs: DataFrame, cls: DataFrame, relations: DataFrame) -> DataFrame:
    """a_cls, b_cls of the pairs whose given names the relations hold together; for pairs that the vocabulary does not relate."""
    of = cls.select("cls", F.explode("forms").alias("f"))
    a, b = of.toDF("a_cls", "x"), of.toDF("b_cls", "y")
    return pairs.select("a_cls", "b_cls").join(a, "a_cls").join(b, "b_cls").join(relations, ["x", "y"], "left_semi").select("a_cls", "b_cls").distinct()


def digest(*cols: str) -> Column:
    """24 characters that differ if a column differs; null differs from ''."""
    return F.base64(F.unhex(F.md5(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))))


def classes_of(parts: DataFrame) -> DataFrame:
    """parts with cls: equal for rows of one state, place, surname and given names."""
    return parts.where(F.col("surname") != "").withColumn("cls", digest("state", "place", "surname", "surname_parts", "forms", "letters", "initial"))


def _sides(cls: DataFrame) -> tuple[DataFrame, DataFrame]:
    cols = ["cls", "state", "place", "surname", "surname_parts", "n", *GIVEN]
    return tuple(cls.select(*[F.col(c).alias(f"{s}_{c}") for c in cols]) for s in "ab")


def near_and_equal(keys: DataFrame) -> DataFrame:
    """grp, name_a, name_b, distance of the names of a group within the radius, and of every name with itself (0)."""
    keys = cut(keys.distinct())
    return metric.radius_join(keys, RADIUS).unionByName(keys.select("grp", F.col("name").alias("name_a"), F.col("name").alias("name_b"), F.lit(0).alias("distance")))


def surname_keys(surname: str, parts: str) -> Column:
    """A surname and, of a compound, its parts: structs of key and full."""
    return F.array_distinct(F.concat(F.array(F.struct(F.col(surname).alias("key"), F.lit(True).alias("full"))), F.transform(parts, lambda p: F.struct(p.alias("key"), F.lit(False).alias("full")))))


def named_keys(side: DataFrame, s: str) -> DataFrame:
    """The placed classes of a side once for each of their surname keys."""
    keyed = side.where(F.col(f"{s}_place") != "").withColumn("k", F.explode(surname_keys(f"{s}_surname", f"{s}_surname_parts")))
    return keyed.withColumns({f"{s}_grp": F.concat_ws("|", f"{s}_state", f"{s}_place"), f"{s}_key": F.col("k.key"), f"{s}_full": F.col("k.full")}).drop("k")


def links(cls: DataFrame, near: DataFrame, cls_contacts: DataFrame, relations: DataFrame) -> DataFrame:
    """a_cls, b_cls: classes that name one person.

    Each kind of link is written on its own: as one plan they were planned anew, all of them, after every stage
    of any, and that set the driver's memory.
    """
    a, b = _sides(cls)
    level = given_level("a", "b")
    ka, kb = (named_keys(x, s) for x, s in ((a, "a"), (b, "b")))
    # part of a compound meets whole surnames only; equal names meet once
    once = (F.col("a_full") | F.col("b_full")) & F.when(F.col("distance") == 0, F.col("a_cls") < F.col("b_cls")).otherwise(F.col("a_cls") != F.col("b_cls"))
    met = near.join(ka, (F.col("grp") == F.col("a_grp")) & (F.col("name_a") == F.col("a_key"))).join(kb, (F.col("grp") == F.col("b_grp")) & (F.col("name_b") == F.col("b_key")) & once)
    keep = ["a_cls", "b_cls", "a_n", "b_n", "a_initial", "b_initial", "a_key", "b_key", "a_full", "b_full", "distance", "level"]
    met = cut(met.withColumn("level", level).select(keep))
    rest = related_rest(met.where("level = 0"), cls, relations).withColumn("known", F.lit(2))
    pairs = cut(met.where("level > 0").unionByName(met.where("level = 0").join(rest, ["a_cls", "b_cls"]).withColumn("level", F.col("known")).drop("known")))
    whole = F.col("a_full") & F.col("b_full")
    swapped = transposed(F.col("a_key"), F.col("b_key"))
    sure = (F.col("level") >= 2) & ((F.col("distance") <= 1) | swapped | (whole & (F.least("a_n", "b_n") <= F.greatest(F.lit(1), F.greatest("a_n", "b_n") / TIMES))))
    # initials alone: the named partners of a class must all be one name
    initial = pairs.where(whole & (F.col("level") == 1) & (F.col("distance") <= 1))
    one_way = lambda a, b: initial.where(f"{a}_initial").select(F.col(f"{a}_cls").alias("i"), F.col(f"{b}_cls").alias("p"))
    both = one_way("a", "b").unionByName(one_way("b", "a"))
    named = cut(both.join(cls.select(F.col("cls").alias("p"), F.col("wider").alias("b_wider")), "p").where(F.size("b_wider") > 0).select("i", "b_wider").distinct())
    partners = named.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    common = named.select("i", F.explode(F.array_distinct("b_wider")).alias("w")).groupBy("i", "w").agg(F.count(F.lit(1)).alias("m"))
    one = common.join(partners, "i").where("m = n").select("i").distinct()  # a name that all partners can stand for
    lone = cut(both.join(one, "i").select(F.col("i").alias("a_cls"), F.col("p").alias("b_cls")))
    # the rest needs a shared contact
    ca, cb = cls_contacts.select(F.col("cls").alias("a_cls"), "contact"), cls_contacts.select(F.col("cls").alias("b_cls"), "contact")
    told = cut(pairs.where(~sure).select("a_cls", "b_cls").join(ca, "a_cls").join(cb, ["b_cls", "contact"]).select("a_cls", "b_cls"))
    # without a place: by contact, or by name if the name occurs in one place of the state only
    lost = a.where("a_place = ''")
    by_name = cut(lost.join(b, (F.col("a_state") == F.col("b_state")) & (F.col("a_surname") == F.col("b_surname")) & (F.col("a_cls") != F.col("b_cls")) & (level >= 2)).select("a_cls", "b_cls", "b_place"))
    single = by_name.groupBy("a_cls").agg(F.countDistinct(F.when(F.col("b_place") != "", F.col("b_place"))).alias("places")).where("places <= 1").select("a_cls")
    close = F.levenshtein("a_surname", "b_surname", RADIUS) >= 0
    by_contact = cut(
        lost.join(ca, "a_cls").join(b.join(cb, "b_cls"), "contact").where((F.col("a_cls") != F.col("b_cls")) & (F.col("a_state") == F.col("b_state")) & (close | F.array_contains("a_surname_parts", F.col("b_surname")) | F.array_contains("b_surname_parts", F.col("a_surname"))) & (level > 0)).select("a_cls", "b_cls")
    )
    all_ = pairs.where(sure).select("a_cls", "b_cls").unionByName(lone).unionByName(told).unionByName(by_name.join(single, "a_cls").select("a_cls", "b_cls")).unionByName(by_contact)
    return all_.select(F.least("a_cls", "b_cls").alias("a_cls"), F.greatest("a_cls", "b_cls").alias("b_cls")).distinct()


def same_person(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, links): unique_id and cls of every record with a surname, and the linked classes.

    Records of one cls name one person. ``records`` has the columns of candidacy records; null names give no
    link, repeated rows count once, an empty table gives empty results.
    """
    parts = cut(snapped_places(cut(names.parts_of_records(records, names.learn_vocabulary(records)))))
    member = cut(classes_of(parts))
    cls = cut(member.groupBy("cls").agg(*[F.first(c).alias(c) for c in ("state", "place", "surname", "surname_parts", *GIVEN)]))
    often = cls.groupBy("state", "place", "surname").agg(F.count(F.lit(1)).alias("_c")).join(member.groupBy("state", "place", "surname").agg(F.count(F.lit(1)).alias("n")), ["state", "place", "surname"]).drop("_c")
    cls = cut(cls.join(often, ["state", "place", "surname"]))
    relations = cut(names.rare_relations(records))
    keys = cls.where("place <> ''").select(F.concat_ws("|", "state", "place").alias("grp"), F.explode(surname_keys("surname", "surname_parts")).alias("k"))
    near = cut(near_and_equal(keys.select("grp", F.col("k.key").alias("name"))))
    return member.select("unique_id", "cls"), cut(links(cls, near, cut(contacts(member, "cls")), relations))


def persons_of(member: DataFrame, linked: DataFrame) -> DataFrame:
    """unique_id and person of every record: one class, or classes linked directly or through others."""
    edge = linked.select(F.explode(F.array("a_cls", "b_cls")).alias("id"), F.concat("a_cls", "b_cls").alias("label"))
    person = components.connected_groups(edge).select(F.col("id").alias("cls"), "group_id")
    return cut(member.join(person, "cls", "left").select("unique_id", F.coalesce("group_id", "cls").alias("person")))


def pairs_of(member: DataFrame, linked: DataFrame) -> DataFrame:
    """id_1 < id_2 of all records of one person."""
    of = persons_of(member, linked)
    return of.select(F.col("unique_id").alias("id_1"), "person").join(of.select(F.col("unique_id").alias("id_2"), "person"), "person").where("id_1 < id_2").select("id_1", "id_2")
