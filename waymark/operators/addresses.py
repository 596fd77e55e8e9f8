"""Places by their addresses: neighbours that share words, the likest address of a road, positions found in steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.geo import haversine_m, sql_distance, within
from waymark.functions.text import ADDRESS_NOISE, ADDRESS_PARTS, address_part, letters, normalise_address, set_jaccard, with_province
from waymark.operators.details import CITY_CENTRES, CITY_REACH_M
from waymark.operators.quality import KOREA
from waymark.plans.durable import forget, small_side, written
from waymark.plans.registry import query

#: Address words that must be shared, and located places reported for each place.
SHARED_WORDS, NEIGHBOURS = 2, 10
#: How sure a position is that was looked up by its address, and one that was estimated.
LOOKUP_CONFIDENCE, ESTIMATE_CONFIDENCE = 0.9, 0.6
#: Likeness down to which candidates are searched by rare characters, in rounds, and sets of a block of what is left.
THRESHOLDS, BLOCK = (0.9, 0.75, 0.6), 1024


def sharing_two_words(rows: DataFrame, most: int = NEIGHBOURS) -> DataFrame:
    """(seq, other, n): for rows without latitude the first `most` located rows (by seq) that share two address words, and
    how many they share.

    Every pair of words of a located address is a key, of which the first `most` rows are kept. That is exact: a row that
    shares two words with an address is found under their pair, or `most` earlier ones are, which share them as well. The
    index is limited before it is shuffled (a rank of at most `most` in each task), so a pair that all addresses have
    is as cheap as any other, and a key has `most` rows to join with. Equal sets of words are looked up once. An address
    of w words has w * (w - 1) / 2 keys. Missing addresses share nothing; repeated words count once.
    """
    worded = rows.select("seq", F.col("lat").isNull().alias("lost"), F.array_sort(F.array_distinct(F.split("address", " "))).alias("words"))

    def pairs(words: Column) -> Column:
        first = F.transform(words, lambda a, i: F.transform(F.slice(words, i + 2, F.size(words)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
        return F.explode(F.flatten(first)).alias("pair")

    known = worded.where("NOT lost").select(F.col("seq").alias("other"), F.col("words").alias("theirs"), pairs(F.col("words")))
    first = F.row_number().over(Window.partitionBy("pair").orderBy("other"))
    index = known.withColumn("rank", first).where(F.col("rank") <= most).drop("rank")
    sets = worded.where("lost").select("words").distinct()
    n = F.size(F.array_intersect("words", "theirs")).cast("long").alias("n")
    found = sets.select("words", pairs(F.col("words"))).join(index, "pair").select("words", "other", n).distinct()
    rank = F.row_number().over(Window.partitionBy("words").orderBy("other"))
    best = written(found.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank"))
    return worded.where("lost").join(small_side(best), "words").select("seq", "other", "n")


@query(f"""WITH w AS (SELECT seq, unnest(list_distinct(string_split(address, ' '))) AS word FROM places WHERE lat IS NOT NULL),
q AS (SELECT seq, unnest(list_distinct(string_split(address, ' '))) AS word FROM places WHERE lat IS NULL),
m AS (SELECT q.seq, w.seq AS other, count(*) AS n FROM q JOIN w USING (word) GROUP BY 1, 2 HAVING count(*) >= {SHARED_WORDS})
SELECT seq, other, n FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY other) AS r FROM m) x WHERE r <= {NEIGHBOURS}""")
def address_neighbours(v):
    """For places without coordinates, the first ten located ones in input order that share at least two address words."""
    return sharing_two_words(v.dealt("places"))


def likest_sets(lost: DataFrame, known: DataFrame) -> DataFrame:
    """(part, chars, best, alike): for each (part, chars) the `best` of the row (part, theirs, best) of greatest Jaccard
    likeness of the two sets of characters, among equals the one with the smallest best.seq.

    Equal sets are joined first. Then, round by round, sets that have a partner of at least a threshold are decided: two
    such sets differ little in size and share one of their rarest characters (as rare as on this part), so only sets
    with such a character in common are compared; whatever meets the threshold beats all that was not compared. What no
    round decides is compared with all sets of its part, dealt to blocks so that a crowded part is many tasks.
    """

    def best_of(pairs: DataFrame) -> DataFrame:
        picked = F.max_by(F.struct("best", "alike"), F.struct("alike", -F.col("best.seq"))).alias("x")
        return pairs.groupBy("part", "chars").agg(picked).select("part", "chars", "x.best", "x.alike")

    known, left = written(known), written(lost.distinct())
    equal = left.join(known, (left["part"] == known["part"]) & (F.col("chars") == F.col("theirs"))).select(left["part"], "chars", "best", F.lit(1.0).alias("alike"))
    decided = [written(best_of(equal))]
    counts = known.select("part", F.explode("theirs").alias("c")).groupBy("part", "c").agg(F.count("*").alias("n"))
    rarity = written(counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("c", "n"))).alias("often")))

    def rare_first(sets: DataFrame, name: str) -> DataFrame:
        order = F.array_sort(F.transform(name, lambda c: F.struct(F.coalesce(F.try_element_at("often", c), F.lit(0)).alias("n"), c.alias("c"))))
        return sets.join(small_side(rarity), "part", "left").withColumn("rare", F.transform(order, lambda x: x["c"])).drop("often")

    ordered = written(rare_first(known, "theirs"))
    for least in THRESHOLDS:
        left = written(left.join(decided[-1], ["part", "chars"], "left_anti"))
        if left.isEmpty():
            break

        def prefix(name: str, least: float = least) -> Column:
            return F.slice("rare", 1, (F.size(name) - F.ceil(F.size(name) * F.lit(least) - 1e-9) + 1).cast("int"))

        mine = rare_first(left, "chars").select("part", "chars", F.explode(prefix("chars")).alias("c"))
        theirs = ordered.select("part", "theirs", "best", F.explode(prefix("theirs")).alias("c"))
        near = (F.size("theirs") >= F.size("chars") * F.lit(least) - 1e-9) & (F.size("chars") >= F.size("theirs") * F.lit(least) - 1e-9)
        alike = set_jaccard(F.col("chars"), F.col("theirs")).alias("alike")
        found = mine.join(theirs, ["part", "c"]).where(near).select("part", "chars", "best", alike).where(F.col("alike") >= least)
        decided.append(written(best_of(found)))
    left = written(left.join(decided[-1], ["part", "chars"], "left_anti"))
    if not left.isEmpty():
        blocks = small_side(written(known.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))))
        dealt = known.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("theirs"), F.col("blocks")).cast("int"))
        asked = left.join(blocks, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pairs = asked.select("part", "chars", "block").join(dealt, ["part", "block"])
        decided.append(written(best_of(pairs.select("part", "chars", "best", set_jaccard(F.col("chars"), F.col("theirs")).alias("alike")))))
    forget(known, ordered, rarity)
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out


def likest_located(lost: DataFrame, known: DataFrame) -> DataFrame:
    """(seq, other, lat, lng, alike): for rows (seq, address) the located row (seq, address, lat, lng) of the likest address
    among those on its road or in its quarter; ties go to the smallest seq. Two rows without a road do not share it."""

    def parts(address: Column) -> Column:
        found = F.array(*[F.when(address_part(address, p).isNotNull(), F.concat(F.lit(p), address_part(address, p))) for p in ("road", "dong")])
        return F.explode(F.array_compact(found)).alias("part")

    address = F.col("address")
    chars = F.array_sort(letters(address))
    theirs = known.select("seq", "lat", "lng", chars.alias("theirs"), parts(address))
    first = F.min_by(F.struct("seq", "lat", "lng"), "seq").alias("best")
    mine = lost.select("seq", chars.alias("chars"), parts(address))
    sets = likest_sets(mine.select("part", "chars"), theirs.groupBy("part", "theirs").agg(first))
    found = mine.join(sets, ["part", "chars"])
    best = F.max_by(F.struct("best", "alike"), F.struct("alike", -F.col("best.seq"))).alias("x")
    return found.groupBy("seq").agg(best).select("seq", F.col("x.best.seq").alias("other"), "x.best.lat", "x.best.lng", "x.alike")


ESTIMATE_SQL = f"""a AS (SELECT seq, lat, lng, nullif(regexp_extract(address, '{ADDRESS_PARTS["road"]}', 1), '') AS road, nullif(regexp_extract(address, '{ADDRESS_PARTS["dong"]}', 1), '') AS dong,
  list_distinct(string_split(address, '')) AS s FROM {{places}}),
c AS (SELECT q.seq, w.seq AS other, w.lat, w.lng, len(list_intersect(q.s, w.s)) * 1.0 / len(list_distinct(list_concat(q.s, w.s))) AS sim
  FROM a q JOIN a w ON q.lat IS NULL AND w.lat IS NOT NULL AND (q.road = w.road OR q.dong = w.dong)),
b AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY sim DESC, other) AS r FROM c)"""


@query(f"""WITH {ESTIMATE_SQL.format(places="places")}
SELECT a.seq, coalesce(a.lat, b.lat) AS lat, coalesce(a.lng, b.lng) AS lng, b.other AS from_seq,
  CASE WHEN a.lat IS NOT NULL THEN 'given' WHEN b.seq IS NOT NULL THEN 'estimated' ELSE 'none' END AS source,
  CAST(CASE WHEN a.lat IS NOT NULL THEN 1.0 WHEN b.seq IS NOT NULL THEN {ESTIMATE_CONFIDENCE} ELSE 0.0 END AS DOUBLE) AS confidence FROM a LEFT JOIN b ON a.seq = b.seq AND b.r = 1""")
def estimated_locations(v):
    """Every place with its position: its own, else that of the place with the likest address on its road or in its quarter."""
    return estimate_locations(v.places)


def estimate_locations(rows: DataFrame) -> DataFrame:
    """(seq, lat, lng, from_seq, source, confidence) of every row: given, estimated or none."""
    own = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    found = written(likest_located(rows.where(~own), rows.where(own)))
    found = found.select("seq", "other", F.col("lat").alias("y"), F.col("lng").alias("x"))
    out = rows.select("seq", "lat", "lng").join(small_side(found), "seq", "left")
    return out.select(
        "seq", F.when(own, F.col("lat")).otherwise(F.col("y")).alias("lat"), F.when(own, F.col("lng")).otherwise(F.col("x")).alias("lng"), F.when(~own, F.col("other")).alias("from_seq"),
        F.when(own, "given").when(F.col("other").isNotNull(), "estimated").otherwise("none").alias("source"),
        F.when(own, 1.0).when(F.col("other").isNotNull(), ESTIMATE_CONFIDENCE).otherwise(0.0).alias("confidence"),
    )


def plausible_position(address: Column, lat: Column, lng: Column) -> Column:
    """Inside the country, and within 50 km of the centre of the first city that the address names."""
    near = F.lit(True)
    for city, (y, x) in reversed(CITY_CENTRES.items()):
        near = F.when(address.contains(city), haversine_m(lat, lng, F.lit(y), F.lit(x)) <= CITY_REACH_M).otherwise(near)
    return F.coalesce(within(lat, lng, KOREA) & near, F.lit(False))


def geocode(rows: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """(seq, address, lat, lng, source, confidence) of every row of (seq, address, lat, lng), found in steps.

    Addresses are stripped of notes and get a province. A plausible own position stands (given, 1). Else the address is
    looked up in `table` (address, lat, lng; without one: the rows with a plausible position, of equal addresses the
    first by seq), and what is found must be plausible (lookup, 0.9). Else the position of the likest address on the same
    road or in the same quarter counts (estimated, 0.6), else there is none. Rows without an address keep a plausible
    position or get none.
    """
    clean = F.when(normalise_address(F.col("address")) != "", with_province(normalise_address(F.col("address"))))
    rows = written(rows.select("seq", clean.alias("address"), "lat", "lng").withColumn("own", plausible_position(F.coalesce("address", F.lit("")), F.col("lat"), F.col("lng"))))
    given = rows.where("own")
    if table is None:
        source = given.where("address IS NOT NULL").groupBy("address").agg(F.min_by(F.struct("lat", "lng"), "seq").alias("p"))
    else:
        renamed = with_province(normalise_address(F.col("address"))).alias("address")
        source = table.select(renamed, "lat", "lng").groupBy("address").agg(F.min(F.struct("lat", "lng")).alias("p"))
    source = source.select(F.col("address").alias("known"), F.col("p.lat").alias("y"), F.col("p.lng").alias("x"))
    lost = rows.where(~F.col("own")).select("seq", "address")
    looked = lost.join(small_side(written(source)), F.col("address") == F.col("known"), "left").withColumn("found", plausible_position(F.col("address"), F.col("y"), F.col("x")))
    looked = written(looked)
    still = looked.where(~F.col("found") & F.col("address").isNotNull()).select("seq", "address")
    guessed = written(likest_located(still, given.select("seq", "address", "lat", "lng")).select("seq", F.col("lat").alias("gy"), F.col("lng").alias("gx")))
    rest = looked.join(small_side(guessed), "seq", "left")
    kind = F.when(F.col("found"), "lookup").when(F.col("gy").isNotNull(), "estimated").otherwise("none")
    rest = rest.select(
        "seq", "address", F.when(F.col("found"), F.col("y")).otherwise(F.col("gy")).alias("lat"), F.when(F.col("found"), F.col("x")).otherwise(F.col("gx")).alias("lng"), kind.alias("source"),
        F.when(F.col("found"), LOOKUP_CONFIDENCE).when(F.col("gy").isNotNull(), ESTIMATE_CONFIDENCE).otherwise(0.0).alias("confidence"),
    )
    return given.select("seq", "address", "lat", "lng", F.lit("given").alias("source"), F.lit(1.0).alias("confidence")).unionByName(rest)


_CLEAN = "trim(coalesce(address, ''))"
for _noise in ADDRESS_NOISE:
    _CLEAN = f"regexp_replace({_CLEAN}, '{_noise}', '', 'g')"
_CLEAN = rf"nullif(trim(regexp_replace({_CLEAN}, '\s+', ' ', 'g')), '')"
_NEAR = "CASE " + " ".join(f"WHEN contains(address, '{c}') THEN {sql_distance('lat', 'lng', str(y), str(x))} <= {CITY_REACH_M}" for c, (y, x) in CITY_CENTRES.items()) + " ELSE true END"

CASCADE_SQL = f"""n0 AS (SELECT seq, lat, lng, {_CLEAN} AS c FROM rough_places),
n AS (SELECT seq, lat, lng, CASE WHEN regexp_matches(c, '{ADDRESS_PARTS["sido"]}') THEN c ELSE '서울 ' || c END AS address FROM n0),
o AS (SELECT *, coalesce(lat BETWEEN {KOREA[0]} AND {KOREA[1]} AND lng BETWEEN {KOREA[2]} AND {KOREA[3]} AND {_NEAR}, false) AS own FROM n),
k AS (SELECT address, arg_min(lat, seq) AS lat, arg_min(lng, seq) AS lng FROM o WHERE own AND address IS NOT NULL GROUP BY address),
l AS (SELECT o.seq, o.address, k.lat, k.lng FROM o LEFT JOIN k USING (address) WHERE NOT own),
r AS (SELECT seq, address, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lng FROM l WHERE lat IS NULL UNION ALL SELECT seq, address, lat, lng FROM o WHERE own),
{ESTIMATE_SQL.format(places="r")}"""


@query(f"""WITH {CASCADE_SQL}
SELECT seq, address, lat, lng, 'given' AS source, 1.0::DOUBLE AS confidence FROM o WHERE own UNION ALL SELECT seq, address, lat, lng, 'lookup', {LOOKUP_CONFIDENCE}::DOUBLE FROM l WHERE lat IS NOT NULL
UNION ALL SELECT l.seq, address, b.lat, b.lng, CASE WHEN b.seq IS NULL THEN 'none' ELSE 'estimated' END, CASE WHEN b.seq IS NULL THEN 0.0 ELSE {ESTIMATE_CONFIDENCE} END::DOUBLE FROM l LEFT JOIN b ON b.seq = l.seq AND b.r = 1 WHERE l.lat IS NULL""")
def geocoded(v):
    """Every place of a rough list with its position, and how it was found."""
    return geocode(v.rough_places)
