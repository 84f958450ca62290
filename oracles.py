"""The same answers as plain SQL over the raw test tables, for DuckDB.

Written row by row, without the pre-aggregation and list tricks of the Spark side.
"""

from __future__ import annotations

LAMBDAS = (0.001, 0.005, 0.01)
ITERATIONS = (10, 12, 16)
BLANKS = " || ".join(f"chr({code})" for code in range(1, 33))

RATINGS = """ratings as materialized (
  select cast(o_custkey as int) as userId, cast(l_partkey as int) as movieId,
         cast(0.5 + (cast(l_quantity as int) - 1) % 10 * 0.5 as double) as rating,
         cast((cast(l_shipdate as date) - date '1970-01-01') * 86400 as int) as timestamp,
         l_returnflag as flag
  from lineitem join orders on l_orderkey = o_orderkey)"""

SPLIT = (
    RATINGS
    + """,
numbered as (
  select userId, movieId, rating,
         row_number() over (order by timestamp, userId, movieId, rating) as rn,
         count(*) over () as n
  from ratings),
train as materialized (
  select userId, movieId, rating from numbered where rn <= floor(n * cast(0.6 as double))),
test as materialized (
  select userId, movieId, rating from numbered where rn > floor(n * cast(0.6 as double)))"""
)

CATALOGUE = """catalogue as (
  select cast(p_partkey as int) as movieId, p_name || ', The "' || p_brand || '"' as title,
         p_type || '|' || p_brand as genres
  from part
  union all
  select cast(p_partkey as int),
         case when p_size = 2 then p_name || ', The "' || p_brand || '" again'
              else 'A ' || p_name || ', The "' || p_brand || '"' end,
         p_type || '|' || p_brand
  from part where p_size in (2, 3))"""

MOVIES = CATALOGUE + """,
movies as (select movieId, min(title) as title from catalogue group by movieId)"""

# Lines of nations that are wrong in each file, by the key modulo 4, and why.
_K = "cast(n_nationkey as varchar)"
WRONG = {
    "links": (_K, f"concat_ws(',', {_K}, {_K}, {_K}, {_K})", f"{_K} || ',,' || {_K}", f"{_K} || ',' || {_K} || ','"),
    "movies": (
        f"{_K} || ',' || n_name", f"{_K} || ',' || n_name || ', The,Drama'",
        "',' || n_name || ',Drama'", f"{_K} || ',' || n_name || ','",
    ),
    "ratings": (
        f"{_K} || ',' || {_K} || ',4.0'", f"concat_ws(',', {_K}, {_K}, '4.0', {_K}, {_K})",
        f"{_K} || ',,4.0,' || {_K}", f"{_K} || ',' || {_K} || ',4.0,'",
    ),
    "tags": (
        f"{_K} || ',' || n_name || ',' || {_K}", None,
        f"{_K} || ',,' || n_name || ',' || {_K}", f"{_K} || ',' || {_K} || ',' || n_name || ','",
    ),
}
REASONS = ("too few fields", "too many fields", "bad value", "empty last field")


def _wrong(table: str, source: str = "nation", key: str = "n_nationkey", name: str = "n_name") -> str:
    nations = "\nunion all\n".join(
        f"select '{table}' as table_name, {line} as value, '{reason}' as reason from nation where n_nationkey % 4 = {case}"
        for case, (line, reason) in enumerate(zip(WRONG[table], REASONS, strict=True))
        if line
    )
    return nations.replace("from nation", f"from {source}").replace("n_nationkey", key).replace("n_name", name)


def _broken_csv() -> str:
    """The same lines of customers; in CSV a comma in a tag outside quotes is one field too many."""
    surplus = f"concat_ws(',', {_K}, {_K}, n_name, ' ' || n_name, {_K})"
    tags = f"select 'tags' as table_name, {surplus} as value, 'too many fields' as reason from nation where n_nationkey % 4 = 1"
    tags = tags.replace("from nation", "from customer").replace("n_nationkey", "c_custkey").replace("n_name", "c_name")
    return "\nunion all\n".join([_wrong(t, "customer", "c_custkey", "c_name") for t in WRONG] + [tags])


POPULAR = """popular as (
  select cast(row_number() over (order by c desc, movieId) as int) as rank, movieId, c
  from (select movieId, count(*) as c from train group by movieId order by c desc, movieId limit 5))"""

REQUESTS = """requests as (
  select value,
         case when contains(value, '|') then try_cast(split_part(value, '|', 1) as int) end as userId
  from (
    select cast(userId as varchar) || '|' || cast(movieId as varchar) || '|' || cast(rating as varchar) as value
    from test
    union all
    select case when event_type = 'error' then props
                else cast(-1 - user_id as varchar) || '|' || cast(event_id as varchar) || '|4.0' end
    from events))"""


def _als() -> str:
    """Rank-1 alternating least squares, one pair of tables per iteration."""
    parts = [f"lambdas as (select unnest([{', '.join(map(str, LAMBDAS))}]::double[]) as lam)"]
    parts.append(
        """i1 as materialized (
  select lam, movieId, sum(rating) / (count(*) + lam * count(*)) as f
  from train cross join lambdas group by lam, movieId)"""
    )
    for step in range(1, max(ITERATIONS) + 1):
        if step > 1:
            parts.append(
                f"""i{step} as materialized (
  select lam, movieId, sum(f * rating) / (sum(f * f) + lam * count(*)) as f
  from train join u{step - 1} using (userId) group by lam, movieId)"""
            )
        parts.append(
            f"""u{step} as materialized (
  select lam, userId, sum(f * rating) / (sum(f * f) + lam * count(*)) as f
  from train join i{step} using (movieId) group by lam, userId)"""
        )
    for kind, key in (("u", "userId"), ("i", "movieId")):
        union = " union all ".join(
            f"select lam, {step} as steps, {key}, f from {kind}{step}" for step in ITERATIONS
        )
        parts.append(f"{kind}_all as materialized ({union})")
    parts.append(
        """grid as materialized (
  select lam, steps, sqrt(avg((rating - u.f * i.f) * (rating - u.f * i.f))) as rmse, count(*) as n
  from test join u_all u using (userId) join i_all i using (movieId, lam, steps)
  group by lam, steps)"""
    )
    parts.append("best as (select * from grid order by rmse, lam, steps limit 1)")
    parts.append("u as materialized (select userId, f from u_all join best using (lam, steps))")
    parts.append("i as materialized (select movieId, f from i_all join best using (lam, steps))")
    return ",\n".join(parts)


def _rank2(lam: float = 0.05, steps: int = 4) -> str:
    """Rank-2 alternating least squares by its normal equations."""
    parts = [
        """p0 as materialized (
  select userId, cast(1 as double) as f0, ((cast(userId as bigint) * 37) % 101) / 101.0::double - 0.5 as f1
  from (select distinct userId from train))"""
    ]
    for step in range(1, steps + 1):
        for new, old, key, other in (
            (f"q{step}", f"p{step - 1}", "movieId", "userId"),
            (f"p{step}", f"q{step}", "userId", "movieId"),
        ):
            parts.append(
                f"""{new} as materialized (
  select {key}, (p * c - q * b) / (a * c - b * b) as f0, (q * a - p * b) / (a * c - b * b) as f1
  from (select {key}, sum(f0 * f0) + {lam}::double * count(*) as a, sum(f0 * f1) as b,
               sum(f1 * f1) + {lam}::double * count(*) as c,
               sum(rating * f0) as p, sum(rating * f1) as q
        from train join {old} using ({other}) group by {key}))"""
            )
    return ",\n".join(parts)


RANK2 = SPLIT + ",\n" + _rank2()


def _solved(sums: str, key: str, rank: int) -> str:
    """``f0 f1 ...`` of the equations in ``sums(key, a<i>_<j>, b<i>)`` by elimination, row after row."""
    out, ranks = sums, range(rank)
    for j in ranks:
        below = range(j + 1, rank)
        new = [f"a{i}_{k} - a{i}_{j} / a{j}_{j} * a{j}_{k} as a{i}_{k}" for i in below for k in below]
        new += [f"b{i} - a{i}_{j} / a{j}_{j} * b{j} as b{i}" for i in below]
        names = [x.rsplit(" ", 1)[1] for x in new]
        keep = f"* exclude ({', '.join(names)})" if names else "*"
        out = f"select {', '.join([keep, *new])} from ({out})"
    for i in reversed(ranks):
        top = "".join(f" - a{i}_{k} * f{k}" for k in range(i + 1, rank))
        out = f"select *, (b{i}{top}) / a{i}_{i} as f{i} from ({out})"
    return f"select {key}, {', '.join(f'f{i}' for i in ranks)} from ({out})"


def _any_rank(rank: int, lam: float, steps: int, mark: str) -> str:
    """Tables ``<mark>p<step>`` and ``<mark>q<step>`` of user and item factors."""
    h = [f"((cast(userId as bigint) * {37 * c}) % 101) / 101.0::double - 0.5 as f{c}" for c in range(1, rank)]
    first = ", ".join(["userId", "cast(1 as double) as f0", *h])
    parts = [f"{mark}p0 as materialized (select {first} from (select distinct userId from train))"]
    sums = [
        f"sum(f{max(i, j)} * f{min(i, j)})" + (f" + {lam}::double * count(*)" if i == j else "") + f" as a{i}_{j}"
        for i in range(rank) for j in range(rank)
    ]
    sums += [f"sum(rating * f{i}) as b{i}" for i in range(rank)]
    for step in range(1, steps + 1):
        for new, old, key, other in (
            (f"{mark}q{step}", f"{mark}p{step - 1}", "movieId", "userId"),
            (f"{mark}p{step}", f"{mark}q{step}", "userId", "movieId"),
        ):
            grouped = f"select {key}, {', '.join(sums)} from train join {old} using ({other}) group by {key}"
            parts.append(f"{new} as materialized ({_solved(grouped, key, rank)})")
    return ",\n".join(parts)


def _sides(users: str, items: str, columns: list[str], places: int) -> str:
    one = "select '{}' as part, {} as id, " + ", ".join(f"round({c}, {places}) as {c}" for c in columns) + " from {}"
    return one.format("user", "userId", users) + " union all " + one.format("item", "movieId", items)


def _listed(users: str, items: str, rank: int, wanted: str = "true", n: int = 5) -> str:
    """A CTE ``listed``: the ``n`` best items of users, every pair scored."""
    score = " + ".join(f"u.f{c} * i.f{c}" for c in range(rank))
    return f"""listed as (
  select userId, cast(rank as int) as rank, movieId, rating from (
    select *, row_number() over (partition by userId order by round(rating, 9) desc, movieId) as rank
    from (select userId, movieId, {score} as rating from {users} u cross join {items} i where {wanted}))
  where rank <= {n})"""


# Fixed values of the checked queries: lambdas and steps of the rank-3 grid, lambda and steps at rank 8.
RANK3_LAMBDAS, RANK3_STEPS, RANK8_LAMBDA, RANK8_STEPS = (0.02, 0.05), (2, 4), 0.05, 2
RANK8 = SPLIT + ",\n" + _any_rank(8, RANK8_LAMBDA, RANK8_STEPS, "")
RANK3 = ",\n".join(
    [SPLIT]
    + [_any_rank(3, lam, RANK3_STEPS[-1], "ab"[k]) for k, lam in enumerate(RANK3_LAMBDAS)]
    + [
        "grid3 as materialized ("
        + " union all ".join(
            f"""select {lam}::double as lam, {step} as steps, '{"ab"[k]}{step}' as model, count(*) as n,
  sqrt(avg((rating - (u.f0 * i.f0 + u.f1 * i.f1 + u.f2 * i.f2)) ** 2)) as rmse
  from test join {"ab"[k]}p{step} u using (userId) join {"ab"[k]}q{step} i using (movieId)"""
            for k, lam in enumerate(RANK3_LAMBDAS) for step in RANK3_STEPS
        )
        + ")",
        "best3 as materialized (select * from grid3 order by rmse, lam, steps limit 1)",
    ]
    + [
        f"{name} as materialized ("
        + " union all ".join(
            f"select * from {m}{side}{step} where '{m}{step}' = (select model from best3)" for m in "ab" for step in RANK3_STEPS
        )
        + ")"
        for name, side in (("u3", "p"), ("i3", "q"))
    ]
)

ALS = SPLIT + ",\n" + _als()

# A product with a positive factor is largest for the largest factors, with a negative one for
# the smallest, and with zero for all alike: five items of each kind are enough at any size.
TOPN = """few as materialized (
  (select * from i order by f desc, movieId limit 5)
  union (select * from i order by f, movieId limit 5)
  union (select * from i order by movieId limit 5)),
topn as (
  select * from (
    select userId, movieId, u.f * few.f as rating,
           cast(row_number() over (partition by userId order by u.f * few.f desc, movieId) as int) as rank
    from u cross join few)
  where rank <= 5)"""

TAGS = f"""select cast(doc_id as int) as userId, cast(n_chars as int) as movieId,
       trim(replace(replace(translate(text, chr(10) || chr(13), '  '), ',', ''), '"', ''), {BLANKS}) as tag,
       cast(doc_id + 1442943290 as int) as timestamp
from documents
union all
select cast(n_nationkey as int), cast(n_nationkey as int), n_name || ' ' || n_name, cast(n_nationkey as int)
from nation where n_nationkey % 4 = 1"""

LINK_VALUE = """cast(p_partkey as varchar) || ', 0' || cast(p_partkey * 7 + 100000 as varchar) || ' ,' ||
       case when p_size = 1 then '' else cast(p_partkey * 3 as varchar) end"""

NTH = "(select max(userId) from (select distinct userId from train order by userId limit 139))"


def _sql(*ctes_and_body: str) -> str:
    *ctes, body = ctes_and_body
    return "with " + ",\n".join(ctes) + "\n" + body


def _outcome() -> str:
    """(table_name, reason) of every raw line, null where it is kept."""
    return "\nunion all\n".join(
        [
            "select 'links' as table_name, case when p_size = 1 then 'empty last field' end as reason from part",
            "select 'movies', null from part",
            "select 'movies', null from part where p_size in (2, 3)",
            "select 'ratings', case when flag = 'R' then 'bad value' end from ratings",
            "select 'tags', null from documents",
            "select 'tags', null from nation where n_nationkey % 4 = 1",
        ]
        + [f"select table_name, reason from ({_wrong(t)})" for t in WRONG]
    )


def all_oracles() -> dict[str, str]:
    top = "select cast(row_number() over (order by {o}) as int) as rank, * from ({q})"
    counted = "select movieId, count(*) as c from train group by movieId order by {o} limit 5"
    return {
        "clean_links": """select cast(p_partkey as int) as movieId, cast(p_partkey * 7 + 100000 as int) as imdbId,
       cast(p_partkey * 3 as int) as tmdbId from part where p_size <> 1""",
        "clean_movies": _sql(CATALOGUE, "select movieId, title, genres from catalogue"),
        "clean_ratings": _sql(
            RATINGS, "select userId, movieId, rating, timestamp from ratings where flag <> 'R'"
        ),
        "clean_tags": TAGS,
        "rejects": _sql(
            RATINGS,
            f"""select 'links' as table_name, {LINK_VALUE} as value, 'empty last field' as reason
from part where p_size = 1
union all
select 'ratings', 'x' || concat_ws(',', userId, movieId, rating, timestamp), 'bad value'
from ratings where flag = 'R'
union all
"""
            + "\nunion all\n".join(map(_wrong, WRONG)),
        ),
        "etl_counts": _sql(
            RATINGS,
            f"outcome as ({_outcome()})",
            """select table_name, count(*) filter (reason is null) as kept,
       count(*) filter (reason = 'empty last field') as dropped,
       count(*) filter (reason <> 'empty last field') as rejected
from outcome group by table_name""",
        ),
        "ingest_tables": _sql(
            RATINGS,
            f"outcome as ({_outcome()})",
            """select table_name, count(*) filter (reason is null) as stored,
       count(*) filter (reason is not null) as rejects, count(*) filter (reason is null) as counted
from outcome group by table_name""",
        ),
        "ingest_rows": _sql(
            RATINGS,
            CATALOGUE,
            f"tags as ({TAGS})",
            """select 'links' as table_name,
       concat_ws('|', p_partkey, p_partkey * 7 + 100000, p_partkey * 3) as fields from part where p_size <> 1
union all select 'movies', concat_ws('|', movieId, title, genres) from catalogue
union all select 'ratings', concat_ws('|', userId, movieId, rating, timestamp) from ratings where flag <> 'R'
union all select 'tags', concat_ws('|', userId, movieId, tag, timestamp) from tags""",
        ),
        "ingest_nothing": _sql(
            f"wrong as ({' union all '.join(_wrong(t, 'customer', 'c_custkey', 'c_name') for t in ('links', 'movies', 'ratings'))})",
            """select table_name, cast(0 as bigint) as stored,
       count(*) filter (reason <> 'empty last field') as rejected,
       count(*) filter (reason = 'empty last field') as dropped
from wrong group by table_name""",
        ),
        "csv_ingest": _sql(
            RATINGS,
            CATALOGUE,
            f"""tags as (
  select cast(doc_id as varchar) as id, coalesce(cast(n_chars as varchar), '') as n,
         trim(translate(text, chr(10) || chr(13), '  '), {BLANKS}) as tag,
         cast(doc_id + 1442943290 as varchar) as timestamp
  from documents)""",
            f"broken as ({_broken_csv()})",
            """select table_name, reason, value from broken
union all select 'links', case when p_size = 1 then 'empty last field' end,
  case when p_size = 1 then concat(p_partkey, ',', p_partkey * 7 + 100000, ',')
       else concat_ws('|', p_partkey, p_partkey * 7 + 100000, p_partkey * 3) end from part
union all select 'movies', null, concat_ws('|', movieId, title, genres) from catalogue
union all select 'ratings', null, concat_ws('|', userId, movieId, rating, timestamp) from ratings
union all select 'tags', case when tag is null or n = '' then 'bad value' end,
  case when tag is null or n = '' then concat(id, ',', n, ',', tag, ',', timestamp)
       else concat_ws('|', id, n, tag, timestamp) end from tags""",
        ),
        "links_not_null": """select cast(p_partkey as int) as movieId, cast(p_partkey * 7 + 100000 as int) as imdbId,
       cast(p_partkey * 3 as int) as tmdbId from part where p_size <> 1""",
        "table_roundtrip": TAGS,
        "ratings_count": "select count(*) as n from lineitem join orders on l_orderkey = o_orderkey",
        "distinct_users": _sql(SPLIT, "select distinct userId from train order by userId"),
        "nth_user": _sql(SPLIT, f"select {NTH} as userId"),
        "movie_rating_counts": _sql(
            SPLIT, "select movieId, count(*) as c from train group by movieId"
        ),
        "popular_top5": _sql(SPLIT, POPULAR, "select rank, movieId, c from popular"),
        "unpopular_top5": _sql(
            SPLIT, top.format(o="c, movieId", q=counted.format(o="c, movieId"))
        ),
        "popular_titles": _sql(
            SPLIT,
            MOVIES,
            POPULAR,
            "select rank, movieId, title, c from popular join movies using (movieId)",
        ),
        "newest_top5": _sql(
            RATINGS,
            top.format(
                o="first_seen desc, movieId",
                q="""select movieId, min(timestamp) as first_seen from ratings
group by movieId order by first_seen desc, movieId limit 5""",
            ),
        ),
        "time_split_train": _sql(SPLIT, "select userId, movieId, rating from train"),
        "time_split_test": _sql(SPLIT, "select userId, movieId, rating from test"),
        "train_test_overlap": _sql(
            SPLIT,
            """select userId, movieId, t.rating, cast(count(*) as double) as weight
from train join test t using (userId, movieId) group by userId, movieId, t.rating""",
        ),
        "rmse_item_mean": _sql(
            SPLIT,
            """select round(sqrt(avg((p - rating) * (p - rating))), 6) as rmse, count(*) as n
from test join (select movieId, avg(rating) as p from train group by movieId) using (movieId)""",
        ),
        "encode_messages": _sql(
            SPLIT,
            """select 'movie_topic' as key,
       cast(userId as varchar) || '|' || cast(movieId as varchar) || '|' || cast(rating as varchar) as value
from test""",
        ),
        "replay_head": _sql(
            SPLIT,
            """select 'movie_topic' as key,
       cast(userId as varchar) || '|' || cast(movieId as varchar) || '|' || cast(rating as varchar) as value
from (select * from test order by userId, movieId, rating limit 10000)""",
        ),
        "title_lookup": _sql(
            SPLIT,
            MOVIES,
            "select userId, movieId, rating, title from test left join movies using (movieId)",
        ),
        "route_known": _sql(
            SPLIT,
            REQUESTS,
            "select userId, value from requests where userId in (select userId from train)",
        ),
        "route_new": _sql(
            SPLIT,
            REQUESTS,
            """select userId, value from requests
where userId is not null and userId not in (select userId from train)""",
        ),
        "cold_start_fallback": _sql(
            SPLIT,
            MOVIES,
            POPULAR,
            REQUESTS,
            """select r.userId, r.requests, p.rank, p.movieId, m.title
from (select userId, count(*) as requests from requests
      where userId is not null and userId not in (select userId from train) group by userId) r
cross join popular p left join movies m on m.movieId = p.movieId""",
        ),
        "als_user_factors": _sql(ALS, "select userId, round(f, 6) as factor from u"),
        "als_item_factors": _sql(ALS, "select movieId, round(f, 6) as factor from i"),
        "als_normal_equations": _sql(SPLIT, "select distinct userId, true as ok from train"),
        "als_rank3_equations": _sql(SPLIT, "select distinct userId, true as ok from train"),
        "als_rank2_factors": _sql(
            RANK2,
            """select 'user' as part, userId as id, round(f0, 4) as f0, round(f1, 4) as f1 from p4
union all select 'item', movieId, round(f0, 4), round(f1, 4) from q4""",
        ),
        "als_rank2_rmse": _sql(
            RANK2,
            """select round(sqrt(avg((rating - u.f0 * i.f0 - u.f1 * i.f1) ** 2)), 4) as rmse, count(*) as n
from test join p4 u using (userId) join q4 i using (movieId)""",
        ),
        "als_rank2_topn_all": _sql(
            RANK2, _listed("p4", "q4", 2), "select userId, rank, movieId, round(rating, 4) as rating from listed"
        ),
        "als_rank8_factors": _sql(
            RANK8, _sides(f"p{RANK8_STEPS}", f"q{RANK8_STEPS}", [f"f{c}" for c in range(8)], 6)
        ),
        "als_rank8_equations": _sql(SPLIT, "select distinct userId, true as ok from train"),
        "als_rank3_grid": _sql(
            RANK3, 'select lam as "lambda", steps as iterations, round(rmse, 6) as rmse, n from grid3'
        ),
        "als_rank3_saved": _sql(RANK3, _sides("u3", "i3", ["f0", "f1", "f2"], 6) + """
union all select 'params', 0, lam, steps::double, round(rmse, 6) from best3"""),
        "als_rank3_topn_all": _sql(
            RANK3, _listed("u3", "i3", 3), "select userId, rank, movieId, round(rating, 6) as rating from listed"
        ),
        "als_rank3_topn_one": _sql(
            RANK3,
            _listed("u3", "i3", 3, f"userId = {NTH}"),
            "select userId, rank, movieId, round(rating, 6) as rating from listed",
        ),
        "als_rank3_topn_titles": _sql(
            RANK3,
            MOVIES,
            _listed("u3", "i3", 3),
            """select userId, rank, movieId, round(rating, 6) as rating, title
from listed left join movies using (movieId)""",
        ),
        "als_rmse_holdout": _sql(ALS, "select round(rmse, 6) as rmse, n from best"),
        "als_rmse_overlap": _sql(
            ALS,
            """select lam as "lambda", steps as iterations,
       round(sqrt(avg((s.rating - u.f * i.f) * (s.rating - u.f * i.f))), 6) as rmse, count(*) as n
from train t join test s using (userId, movieId)
join u_all u using (userId) join i_all i using (movieId, lam, steps)
group by lam, steps""",
        ),
        "als_grid": _sql(
            ALS,
            """select lam as "lambda", steps as iterations, round(rmse, 6) as rmse, n from grid""",
        ),
        "als_grid_best": _sql(
            ALS,
            """select lam as "lambda", steps as iterations, round(rmse, 6) as rmse from best""",
        ),
        "als_topn_all": _sql(
            ALS, TOPN, "select userId, rank, movieId, round(rating, 6) as rating from topn"
        ),
        "topn_table": _sql(
            ALS, TOPN, "select userId, rank, movieId, round(rating, 6) as rating from topn"
        ),
        "als_topn_one": _sql(
            ALS,
            TOPN,
            f"""select userId, rank, movieId, round(rating, 6) as rating from topn
where userId = {NTH}""",
        ),
        "als_topn_titles": _sql(
            ALS,
            MOVIES,
            TOPN,
            """select userId, rank, movieId, round(rating, 6) as rating, title
from topn left join movies using (movieId)""",
        ),
        "als_save_load": _sql(
            ALS,
            """select 'user' as part, userId as id, round(f, 6) as factor from u
union all select 'item', movieId, round(f, 6) from i
union all select 'lambda', 0, lam from best
union all select 'iterations', 0, cast(steps as double) from best
union all select 'rmse', 0, round(rmse, 6) from best""",
        ),
        "stream_decode": _sql(
            SPLIT, REQUESTS, "select 'movie_topic' as key, value, userId from requests"
        ),
        "stream_replay": _sql(
            SPLIT,
            """select cast(floor((position - 1) / 10000) as int) as batch_id, userId,
       cast(userId as varchar) || '|' || cast(movieId as varchar) || '|' || cast(rating as varchar) as value
from (select *, row_number() over (order by userId, movieId, rating) as position from test)""",
        ),
        "stream_route": _sql(
            SPLIT,
            REQUESTS,
            """select userId, value,
       case when userId in (select userId from train) then 'known' else 'new' end as route
from requests where userId is not null""",
        ),
        "stream_serve": _sql(
            ALS,
            MOVIES,
            POPULAR,
            REQUESTS,
            TOPN,
            """select a.userId, source, l.rank, l.movieId, m.title, cast(requests as bigint) as requests
from (select userId, count(*) as requests,
             case when userId is null then 'reject'
                  when userId in (select userId from train) then 'model' else 'popular' end as source
      from requests group by userId) a
left join (select userId, 'model' as kind, rank, movieId from topn
           union all
           select r.userId, 'popular', p.rank, p.movieId
           from (select distinct userId from requests
                 where userId is not null and userId not in (select userId from train)) r
           cross join popular p) l
  on l.userId = a.userId and l.kind = a.source
left join movies m on m.movieId = l.movieId""",
        ),
        "stream_report": _sql(
            SPLIT,
            REQUESTS,
            """select cast(floor((position - 1) / 10000) as bigint) as batch_id, count(userId) as kept,
       count(*) filter (userId is null) as rejected,
       5 * count(distinct userId) + cast(bool_or(userId is null) as int) as answered
from (select *, row_number() over (order by value) as position from requests)
group by batch_id""",
        ),
    }
