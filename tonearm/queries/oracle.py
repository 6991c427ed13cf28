"""Common table expressions for the checking SQL, in the DuckDB dialect.

They are written from the definitions of the tables, with windows and outer joins, and share no
text with the Spark jobs.
"""

from __future__ import annotations

import re

from tonearm.queries.fixtures import BASE_TABLES, VIEWS

CTES = {name: text.format_map({t: t for t in (*BASE_TABLES, *VIEWS)}) for name, text in VIEWS.items()}

CTES |= {
    "dim_album": """
select album_id as album_key, name, url,
  case when cover_image is null or cover_image = '' then 'unknown' else cover_image end as cover_image,
  case album_type when 'album' then 1 when 'single' then 2 when 'compilation' then 3 else -1 end as album_type,
  cast(case when release_date is null or release_date = '' then '0000' else substr(release_date, 1, 4) end
    || case when length(release_date) >= 7 then substr(release_date, 6, 2) else '00' end
    || case when length(release_date) = 10 then substr(release_date, 9, 2) else '00' end as integer) as release_date_key,
  case release_date_precision when 'year' then 1 when 'month' then 2 when 'day' then 3 else -1 end as release_date_precision,
  case when label is null or label = '' then 'unknown' else label end as label
from src_album""",
    "dim_artist": """
select artist_id as artist_key, coalesce(name, 'unknown') as name, genres, url,
  coalesce(followers_count, -1) as followers_count, coalesce(monthly_listeners, -1) as monthly_listeners
from src_artist""",
    "genre_name": """
select distinct lower(g) as name from (select unnest(genres) as g from src_artist)""",
    "dim_genre": """
select row_number() over (order by name) as genre_key, name from genre_name
union all select -1, 'unknown'""",
    "dim_user": "select user_id as user_key, name, url from src_user",
    "dim_playlist": """
select playlist_id as playlist_key, name, url, collaborative, public as is_public, snapshot_id,
  coalesce(followers_count, -1) as followers_count, user_id as user_key from src_playlist""",
    "dim_track": """
select track_id as track_key, case when name = '' then 'unknown' else name end as name, url,
  album_id as album_key, coalesce(disc_number, -1) as disc_number, duration_ms,
  coalesce(explicit, false) as is_explicit, coalesce(plays_count, -1) as plays_count
from src_track""",
    "dim_day": """
select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as date_actual,
  dayofweek(d) + 1 as day_of_week, day(d) as day_of_month, dayofyear(d) as day_of_year,
  month(d) as month_of_year, monthname(d) as month_name, quarter(d) as quarter, year(d) as year,
  dayofweek(d) in (0, 6) as is_weekend
from (select unnest(generate_series(date '1700-01-01', date '2099-12-31', interval 1 day)) as d)""",
    "dim_date": """
select * from dim_day
union all select 0, null, -1, -1, -1, -1, 'unknown', -1, -1, null
union all select y * 10000, null, -1, -1, -1, -1, 'unknown', -1, y, null from (select unnest(range(1700, 2100)) as y)
union all select y * 10000 + m * 100, null, -1, -1, -1, m, monthname(make_date(2000, m, 1)), -1, y, null
  from (select unnest(range(1700, 2100)) as y), (select unnest(range(1, 13)) as m)""",
    "artist_genre": """
select artist_key, lower(unnest(case when genres is null or len(genres) = 0 then [null] else genres end)) as genre
from dim_artist""",
    "artist_genre_key": """
select distinct artist_key, coalesce(d.genre_key, -1) as genre_key
from artist_genre left join dim_genre d on coalesce(nullif(genre, ''), 'unknown') = d.name""",
    "fact_album_track_all": """
select distinct a.release_date_key, a.album_key, g.artist_key, g.genre_key, t.track_id as track_key,
  cast(t.created_at as date) as created_on
from src_track t join dim_album a on t.album_id = a.album_key
  left join src_artist_album b on b.album_id = t.album_id
  left join artist_genre_key g on g.artist_key = b.artist_id
where g.artist_key is not null""",
    "fact_album_track": """
select release_date_key, album_key, artist_key, genre_key, track_key from fact_album_track_all
where created_on = date '2024-01-02'""",
    "fact_playlist_track": """
select distinct cast(strftime(cast(substr(e.added_at, 1, 10) as date), '%Y%m%d') as integer) as added_date_key,
  coalesce(p.playlist_key, 'unknown') as playlist_key, coalesce(p.user_key, 'unknown') as user_key,
  g.genre_key, e.track_id as track_key, cast(substr(e.added_at, 1, 10) as date) as date_actual
from src_playlist_track e left join dim_playlist p on e.playlist_id = p.playlist_key
  left join src_artist_track b on b.track_id = e.track_id
  left join artist_genre_key g on g.artist_key = b.artist_id
where g.artist_key is not null""",
}


#: A fact that the checking SQL of a query reads more than once.
STORED_FACTS = "materialized: select * from fact_playlist_track"


def _cte(name: str, text: str) -> str:
    if text.startswith("materialized:"):
        return f"{name} as materialized ({text.removeprefix('materialized:').strip()})"
    return f"{name} as ({text})"


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """The SQL with every expression it uses, directly or not, put in front."""
    known = CTES | (extra or {})
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    head = ",\n".join(_cte(name, known[name].strip()) for name in needed)
    return f"with {head}\n{sql.strip()}"
