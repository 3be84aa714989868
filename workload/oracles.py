"""The same results in DuckDB SQL, straight from the generated tables."""

from __future__ import annotations

TIERS = "['IRON','BRONZE','SILVER','GOLD','PLATINUM','EMERALD','DIAMOND','MASTER','GRANDMASTER','CHALLENGER']"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
TIER = f"{TIERS}[{K} % 10 + 1]"
PLATFORM_CASE = (
    "CASE event_type WHEN 'view' THEN 'br1' WHEN 'click' THEN 'na1' WHEN 'purchase' THEN 'kr' "
    "WHEN 'signup' THEN 'euw1' ELSE 'xx9' END"
)


def ladder(platform: str = "'br1'") -> str:
    return f"""
    SELECT 'acct-' || user_id AS puuid, {platform} AS platform, 'RANKED_SOLO_5x5' AS queue_type,
           {TIER} AS tier,
           CASE WHEN {K} % 10 >= 7 THEN 'I' ELSE ['I','II','III','IV'][event_id % 4 + 1] END AS division,
           CAST(floor(value) AS INTEGER) AS league_points, {K} AS wins, 100 - {K} AS losses,
           false AS inactive, ts AS fetched_at
    FROM events"""


def latest(source: str, keys: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY fetched_at DESC, tier, league_points) AS rn
      FROM ({source})) WHERE rn = 1"""


CHECKPOINT = "SELECT 'acct-' || user_id AS puuid, ts AS listed_at FROM events WHERE event_type = 'view'"
AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
RECENT = f"SELECT DISTINCT puuid FROM ({CHECKPOINT}) WHERE listed_at > {AS_OF} - INTERVAL 24 HOUR"
GOLD_UP = "('GOLD','PLATINUM','EMERALD','DIAMOND','MASTER','GRANDMASTER','CHALLENGER')"

LISTING = """
    SELECT 'acct-' || l_partkey AS account, 'M_' || l_orderkey AS match_id, l_shipdate AS played_at,
           CASE l_returnflag WHEN 'R' THEN 420 WHEN 'A' THEN 440 ELSE 450 END AS queue_id
    FROM lineitem"""
STORED = "SELECT 'M_' || o_orderkey AS match_id FROM orders WHERE o_orderstatus = 'F'"
STORED_TIMELINES = STORED + " AND o_orderpriority <> '1-URGENT'"
SINCE = "TIMESTAMP '1998-01-01 00:00:00'"

NUMBERED = """
    SELECT account, row_number() OVER (ORDER BY account) - 1 AS pos,
           (row_number() OVER (ORDER BY account) - 1) // 100 AS batch_no
    FROM (SELECT DISTINCT 'acct-' || p_partkey AS account FROM part)"""


def crawl(numbered: str, listing: str, budget: int | None, tail: str) -> str:
    """Per-batch allowance from running sums over all batches, then a rank inside each batch."""
    if budget is None:
        listed, allowance = "true", "u.unseen"
    else:
        listed = f"""(u.batch_no = 0 OR u.used < {budget} OR (
            {budget} - p.used - p.accounts > 0 AND ({budget} - p.used - p.accounts) % 2 = 1
            AND 2 * p.unseen > {budget} - p.used - p.accounts))"""
        allowance = f"greatest(0, CAST(floor(({budget} - u.used - u.accounts) / 2.0) AS BIGINT))"
    return f"""
    WITH numbered AS ({numbered}),
    found AS (SELECT DISTINCT n.batch_no, l.match_id FROM numbered n JOIN ({listing}) l USING (account)),
    unseen AS (
      SELECT match_id, min(batch_no) AS batch_no FROM found
      WHERE match_id NOT IN ({STORED}) GROUP BY match_id),
    sizes AS (
      SELECT b.batch_no, b.accounts, coalesce(f.n, 0) AS found, coalesce(s.n, 0) AS unseen
      FROM (SELECT batch_no, count(*) AS accounts FROM numbered GROUP BY 1) b
      LEFT JOIN (SELECT batch_no, count(*) AS n FROM found GROUP BY 1) f USING (batch_no)
      LEFT JOIN (SELECT batch_no, count(*) AS n FROM unseen GROUP BY 1) s USING (batch_no)),
    used AS (
      SELECT *, coalesce(sum(accounts + 2 * unseen) OVER (
        ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM sizes),
    costs AS (
      SELECT u.*, {listed} AS listed, CASE WHEN {listed} THEN least(u.unseen, {allowance}) ELSE 0 END AS fetched
      FROM used u LEFT JOIN used p ON p.batch_no = u.batch_no - 1),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY match_id) - 1 AS pos FROM unseen)
    {tail}"""


FETCH = """SELECT r.batch_no, r.match_id, r.pos, r.pos // 50 AS fetch_no, CAST(r.pos % 4 AS INTEGER) AS worker
    FROM ranked r JOIN costs c USING (batch_no) WHERE r.pos < c.fetched"""
DEFERRED = "SELECT r.batch_no, r.match_id FROM ranked r JOIN costs c USING (batch_no) WHERE c.listed AND r.pos >= c.fetched"
PROGRESS = """SELECT batch_no, accounts, found, unseen, CAST(fetched AS BIGINT) AS fetched,
      CAST(sum(accounts) OVER w AS BIGINT) AS accounts_listed, CAST(sum(fetched) OVER w AS BIGINT) AS matches_written,
      CAST(sum(accounts + 2 * fetched) OVER w AS BIGINT) AS budget_used,
      sum(accounts + 2 * fetched) OVER w > 12000 AS over_budget, (SELECT count(*) FROM numbered) AS accounts_total,
      CAST((SELECT count(*) FROM numbered) - sum(accounts) OVER w AS BIGINT) AS accounts_left
    FROM costs WHERE listed WINDOW w AS (ORDER BY batch_no)"""
LANDED = f"""SELECT account AS puuid, 'br1' AS platform, {AS_OF} AS listed_at FROM numbered
    WHERE batch_no NOT IN (
      SELECT batch_no FROM unseen WHERE match_id IN (
        SELECT 'M_' || o_orderkey FROM orders WHERE o_totalprice > 499950)
      OR match_id NOT IN (SELECT 'M_' || o_orderkey FROM orders))"""

LANDED_CUT = f"""SELECT account AS puuid, 'br1' AS platform, {AS_OF} AS listed_at
    FROM numbered JOIN costs USING (batch_no) WHERE listed AND fetched = unseen"""

RECENT_LISTING = f"SELECT * FROM ({LISTING}) WHERE played_at > {SINCE}"
MOVED_LISTING = f"SELECT * REPLACE (played_at + INTERVAL 8240 DAY AS played_at) FROM ({LISTING})"
LAST_LISTED = f"SELECT puuid, max(listed_at) AS last FROM ({CHECKPOINT}) WHERE listed_at <= {AS_OF} GROUP BY 1"


def since_last(hours: int) -> str:
    return f"""
    SELECT l.* FROM ({MOVED_LISTING}) l LEFT JOIN ({LAST_LISTED}) c ON c.puuid = l.account
    WHERE l.played_at > coalesce(c.last, {AS_OF} - INTERVAL {hours} HOUR)"""


COHORT_NUMBERED = f"""
    SELECT puuid AS account, (row_number() OVER (ORDER BY puuid) - 1) // 100 AS batch_no FROM (
      SELECT puuid FROM ({latest(ladder(), 'puuid')}) WHERE tier IN {GOLD_UP} ORDER BY puuid LIMIT 1000)"""

COHORT_FIXED = f"""
    SELECT puuid AS account, (row_number() OVER (ORDER BY puuid) - 1) // 100 AS batch_no FROM (
      SELECT puuid FROM ({latest(ladder(), 'puuid')}) WHERE tier IN {GOLD_UP} ORDER BY puuid LIMIT 1000)
    WHERE puuid NOT IN ({RECENT})"""
TWO_DAYS = f"""SELECT * REPLACE ({AS_OF} - to_hours(CAST(substr(match_id, 3) AS BIGINT) % 48) AS played_at) FROM ({LISTING})"""

SILVER = """
    SELECT 'M_' || o_orderkey AS match_id, 'br1' AS platform, TIMESTAMP '2024-02-01 06:00:00' AS fetched_at,
           o_orderdate AS created_at, o_custkey % 1800 + 900 AS duration_seconds,
           CASE WHEN o_orderstatus = 'F' THEN 420 ELSE 450 END AS queue_id,
           CAST(o_orderkey % 3 + 10 AS INTEGER) AS map_id, '14.' || month(o_orderdate) AS game_version
    FROM orders"""

PLAYERS = """
    SELECT 'M_' || o_orderkey AS match_id, 'br1' AS platform, TIMESTAMP '2024-02-01 06:00:00' AS fetched_at,
      CAST(s AS INTEGER) AS seat, 'player' || (o_custkey * 10 + s) || '#BR1' AS player,
      'player' || (o_custkey * 10 + s) AS game_name, 'BR1' AS tag_line,
      CASE WHEN s <= 5 THEN 100 ELSE 200 END AS team_id,
      ['TOP','JUNGLE','MIDDLE','BOTTOM','UTILITY'][(s - 1) % 5 + 1] AS team_position,
      CAST((o_custkey + s) % 160 AS INTEGER) AS champion_id, 'Champion' || ((o_custkey + s) % 160) AS champion_name,
      CAST((o_orderkey + s) % 17 AS INTEGER) AS kills, CAST((o_orderkey * 3 + s) % 13 AS INTEGER) AS deaths,
      CAST((o_orderkey * 5 + s) % 19 AS INTEGER) AS assists,
      CAST((o_orderkey * 7 + s) % 301 AS INTEGER) AS minions_killed,
      CAST(floor(o_totalprice) + s AS INTEGER) AS gold_earned,
      CAST(floor(o_totalprice) * 2 + s AS INTEGER) AS damage_to_champions,
      CAST((o_orderkey * 11 + s) % 97 AS INTEGER) AS vision_score, (s <= 5) = (o_orderstatus = 'F') AS win
    FROM orders, range(1, 11) r(s)"""

WORDS = """
    SELECT match_id, 'br1' AS platform, CAST(i - 1 AS INTEGER) AS minute, CAST(length(word) AS INTEGER) AS size
    FROM (SELECT 'M_' || (conv_id * 10 + turn) AS match_id, unnest(string_split(text, ' ')) AS word,
                 generate_subscripts(string_split(text, ' '), 1) AS i FROM conversations)"""
SEATS = f"""
    SELECT match_id, platform, minute, CAST(p AS INTEGER) AS participant,
           CAST(minute * 100 + size * p + 500 AS INTEGER) AS gold, CAST(minute * p AS INTEGER) AS xp,
           CAST((size + p) % 7 AS INTEGER) AS cs
    FROM ({WORDS}), range(1, 11) r(p) WHERE p <= CASE WHEN size = 1 THEN 9 ELSE 10 END"""
PIVOT = "SELECT match_id, platform, minute, " + ", ".join(
    f"coalesce(max(gold) FILTER (participant = {p}), -1) AS p{p}" for p in range(1, 11)
) + f" FROM ({SEATS}) GROUP BY ALL"
PIVOT_TAIL = f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY match_id, platform ORDER BY minute DESC) AS rn FROM ({PIVOT})) WHERE rn <= 5"""
HAPPENED = f"""
    SELECT match_id, platform, minute, size, 0 AS pos,
           ['ITEM_PURCHASED','WARD_PLACED','CHAMPION_KILL','LEVEL_UP'][size % 4 + 1] AS type FROM ({WORDS}) WHERE size > 0
    UNION ALL
    SELECT match_id, platform, minute, size, 1, 'CHAMPION_KILL' FROM ({WORDS}) WHERE size > 6"""
FEED = f"""
    SELECT match_id, minute, pos, type, CAST(minute AS BIGINT) * 60000 + pos AS timestamp,
      CASE WHEN kill THEN minute % 10 + 1 ELSE -1 END AS killer_id,
      CASE WHEN kill THEN (minute + 5) % 10 + 1 ELSE -1 END AS victim_id,
      CASE WHEN kill THEN ((minute + 1) % 10 + 1) || ',' || ((minute + 2) % 10 + 1) END AS assists,
      CASE WHEN kill THEN minute * 10 ELSE -1 END AS x, CASE WHEN kill THEN size * 10 ELSE -1 END AS y
    FROM (SELECT *, type = 'CHAMPION_KILL' AS kill FROM ({HAPPENED}))"""

DOUBTFUL = """
    SELECT 'M_' || o_orderkey AS match_id, CASE WHEN o_orderstatus = 'F' THEN 1 END AS duration_seconds
    FROM orders, range(1, 3) r(copy) WHERE copy = 1 OR o_orderstatus = 'P'"""

SPEC_ENTRIES = """
    SELECT request, CAST(i - 1 AS INTEGER) AS ordinal, raw, trim(raw, chr(32) || chr(9) || chr(10) || chr(13)) AS entry
    FROM (SELECT request, unnest(string_split(spec, ',')) AS raw, generate_subscripts(string_split(spec, ','), 1) AS i
          FROM (SELECT c_custkey AS request, c_name || '#' || c_mktsegment || ' , other ' || c_custkey
                  || '#A#B,,no tag ' || c_nationkey AS spec FROM customer))"""
SPLIT_ENTRIES = f"""
    SELECT request, ordinal, raw,
           CASE WHEN instr(entry, '#') > 0 THEN substr(entry, 1, instr(entry, '#') - 1) ELSE entry END AS game_name,
           CASE WHEN instr(entry, '#') > 0 THEN substr(entry, instr(entry, '#') + 1) ELSE '' END AS tag_line
    FROM ({SPEC_ENTRIES})"""

BUCKETS = f"""
    SELECT tier, CAST(i AS INTEGER) AS tier_rank, division FROM (
      SELECT {TIERS}[i + 1] AS tier, i, unnest(CASE WHEN i < 7 THEN ['I','II','III','IV'] ELSE ['I'] END) AS division
      FROM range(0, 10) r(i))"""


PAGES = f"""
    SELECT puuid, 'br1' AS platform, queue_type, tier, division, league_points, wins, losses, inactive,
           TIMESTAMP '2024-02-01 06:00:00' AS fetched_at FROM (
      SELECT 'acct-' || event_id AS puuid, 'RANKED_SOLO_5x5' AS queue_type, {TIER} AS tier, 'I' AS division,
             CAST(floor(value) AS INTEGER) AS league_points, {K} AS wins, CAST(user_id AS INTEGER) AS losses,
             event_type = 'error' AS inactive FROM events
      UNION ALL
      SELECT 'bare-' || event_id, NULL, NULL, NULL, -1, -1, -1, false FROM events)"""


def shares(sizes: str) -> str:
    return f"""
    SELECT table_name, records, CAST(logical_bytes AS BIGINT) AS logical_bytes,
           CAST(logical_bytes AS DOUBLE) / records AS bytes_per_record,
           CAST(logical_bytes AS DOUBLE) / CAST((SELECT sum(logical_bytes) FROM ({sizes})) AS DOUBLE) AS share
    FROM ({sizes})"""


def totals(source: str) -> str:
    return f"""
    SELECT CASE grouping(tier, division) WHEN 0 THEN 'bucket' WHEN 1 THEN 'tier' ELSE 'total' END AS level,
           tier, division, count(*) AS n FROM ({source}) GROUP BY ROLLUP (tier, division)"""


MEASURE = "count(*) AS records, sum(octet_length(encode({0}))) AS logical_bytes"

ORACLES: dict[str, str] = {
    "latest_per_key": latest(ladder(PLATFORM_CASE), "platform, puuid"),
    "recently_listed": RECENT,
    "tier_filter": f"""
        SELECT puuid, tier, CAST(list_position({TIERS}, tier) - 1 AS BIGINT) AS tier_rank, league_points
        FROM ({ladder()}) WHERE list_position({TIERS}, tier) - 1 >= 4""",
    "select_cohort": f"""
        SELECT * FROM (
          SELECT puuid, tier, league_points FROM ({latest(ladder(), 'puuid')}) WHERE tier IN {GOLD_UP}
          ORDER BY puuid LIMIT 60) WHERE puuid NOT IN ({RECENT})""",
    "exclude_recent": f"SELECT puuid, tier FROM ({latest(ladder(), 'puuid')}) WHERE puuid NOT IN ({RECENT})",
    "since_last_listed": since_last(24),
    "rank_buckets": f"""
        SELECT b.tier, b.tier_rank, b.division, count(l.puuid) AS n
        FROM ({BUCKETS}) b LEFT JOIN ({ladder()}) l USING (tier, division) GROUP BY ALL""",
    "tier_breakdown": f"SELECT tier, count(*) AS n FROM ({latest(ladder(), 'puuid')}) GROUP BY tier",
    "parse_ids": f"SELECT request, ordinal, game_name, tag_line FROM ({SPLIT_ENTRIES}) WHERE game_name <> '' OR tag_line <> ''",
    "parse_id_rejects": f"SELECT request, ordinal, raw FROM ({SPLIT_ENTRIES}) WHERE game_name = '' AND tag_line = ''",
    "list_ids": f"""
        SELECT account, match_id, played_at, 420 AS queue_id FROM (
          SELECT *, row_number() OVER (PARTITION BY account ORDER BY played_at DESC, match_id DESC) AS rn FROM (
            SELECT account, match_id, max(played_at) AS played_at FROM ({LISTING})
            WHERE played_at > {SINCE} AND queue_id = 420 GROUP BY ALL)) WHERE rn <= 3""",
    "list_ids_full": f"""
        SELECT account, match_id, max(played_at) AS played_at, CAST(arg_max(queue_id, played_at) AS INTEGER) AS queue_id
        FROM ({LISTING}) GROUP BY account, match_id""",
    "account_batches": NUMBERED,
    "discovered_ids": f"""
        SELECT match_id, min(batch_no) AS batch_no FROM ({NUMBERED}) JOIN ({RECENT_LISTING}) USING (account) GROUP BY match_id""",
    "known_ids": f"SELECT DISTINCT match_id FROM ({LISTING}) WHERE match_id IN ({STORED})",
    "unseen_ids": f"SELECT match_id, account FROM ({LISTING}) WHERE match_id NOT IN ({STORED})",
    "complete_ids": f"SELECT match_id, 'br1' AS platform FROM ({STORED_TIMELINES})",
    "missing_timelines": f"SELECT match_id, 'br1' AS platform FROM ({STORED}) WHERE match_id NOT IN ({STORED_TIMELINES})",
    "crawl_plan": crawl(NUMBERED, RECENT_LISTING, 12_000, FETCH),
    "crawl_plan_in_place": crawl(NUMBERED, RECENT_LISTING, 12_000, FETCH),
    "crawl_plan_unbounded": crawl(NUMBERED, RECENT_LISTING, None, FETCH),
    "crawl_deferred": crawl(NUMBERED, RECENT_LISTING, 12_000, DEFERRED),
    "run_progress": crawl(NUMBERED, RECENT_LISTING, 12_000, PROGRESS),
    "landed_checkpoint": crawl(NUMBERED, RECENT_LISTING, None, LANDED),
    "landed_checkpoint_cut": crawl(NUMBERED, RECENT_LISTING, 12_000, LANDED_CUT),
    "flatten_event_props": f"SELECT event_id, {K} AS k, CAST(NULL AS VARCHAR) AS missing FROM events",
    "silver_matches": SILVER,
    "silver_matches_permissive": f"""
        SELECT match_id, platform, CASE o_orderstatus WHEN 'F' THEN duration_seconds ELSE -1 END AS duration_seconds,
          CASE WHEN o_orderstatus IN ('F', 'P') THEN queue_id ELSE -1 END AS queue_id,
          CASE WHEN o_orderstatus IN ('F', 'P') THEN game_version ELSE 'none' END AS game_version,
          o_orderstatus NOT IN ('F', 'P') AS no_created_at, o_orderstatus <> 'F' AS no_duration_seconds,
          o_orderstatus NOT IN ('F', 'P') AS no_queue_id
        FROM ({SILVER}) JOIN (SELECT 'M_' || o_orderkey AS match_id, o_orderstatus FROM orders) USING (match_id)""",
    "silver_rejects": """
        SELECT 'M_' || o_orderkey AS match_id, 'br1' AS platform,
               CASE o_orderstatus WHEN 'P' THEN 'duration_seconds' ELSE 'malformed' END AS reason
        FROM orders WHERE o_orderstatus <> 'F'""",
    "newest": f"SELECT match_id, created_at, queue_id FROM ({SILVER}) ORDER BY created_at DESC, match_id LIMIT 25",
    "participants": PLAYERS,
    "scoreboard": f"SELECT * EXCLUDE (fetched_at, player, tag_line, champion_id) FROM ({PLAYERS})",
    "participant_rejects": """
        SELECT 'M_' || o_orderkey AS match_id, 'br1' AS platform,
          CASE o_orderkey % 12 WHEN 0 THEN 'malformed' WHEN 4 THEN 'missing' ELSE 'wrong type' END AS reason
        FROM orders WHERE o_orderkey % 12 IN (0, 4, 8)""",
    "timeline_rejects": f"""
        SELECT 'M_' || (conv_id * 10 + turn) AS match_id, CASE (conv_id * 10 + turn) % 12 WHEN 4 THEN 'missing' ELSE 'malformed' END AS reason
        FROM conversations WHERE (conv_id * 10 + turn) % 12 IN (0, 4, 8)
        UNION ALL
        SELECT DISTINCT match_id, 'kept' FROM ({SEATS}) WHERE CAST(substr(match_id, 3) AS BIGINT) % 12 NOT IN (0, 4, 8)""",
    "key_scoped_ids": """
        SELECT 'M_' || o_orderkey AS match_id, CAST(s AS INTEGER) AS seat, 'k1-' || o_orderkey || '-' || s AS puuid,
               's-k1-' || o_orderkey AS summoner_id FROM orders, range(1, 11) r(s)""",
    "stable_view": f"SELECT * EXCLUDE (fetched_at), 0 AS surplus FROM ({PLAYERS}) WHERE player IS NULL",
    "stable_view_changed": f"""
        SELECT * EXCLUDE (fetched_at), 1 AS surplus FROM ({PLAYERS}) WHERE CAST(substr(match_id, 3) AS BIGINT) % 500 = 0""",
    "player_matches": f"SELECT player, count(*) AS matches FROM ({PLAYERS}) GROUP BY player",
    "identity": """
        SELECT c_mktsegment || '#' || c_name AS player, c_name || '#' || nullif(c_mktsegment, 'BUILDING') AS half,
               c_mktsegment AS game_name, c_name AS tag_line FROM customer""",
    "with_timeline": f"""
        SELECT m.match_id, 'br1' AS platform, m.duration_seconds, m.queue_id,
               TIMESTAMP '2024-02-01 06:00:00' AS timeline_fetched_at, t.frames, t.events
        FROM ({SILVER}) m JOIN (
          SELECT match_id, CAST(count(*) AS INTEGER) AS frames,
                 CAST(count(*) FILTER (size > 0) + count(*) FILTER (size > 6) AS INTEGER) AS events
          FROM ({WORDS}) GROUP BY match_id) t USING (match_id)""",
    "with_region": f"""
        SELECT puuid, platform, CASE platform WHEN 'br1' THEN 'americas' WHEN 'na1' THEN 'americas' WHEN 'kr' THEN 'asia'
               WHEN 'euw1' THEN 'europe' END AS region, league_points FROM ({ladder(PLATFORM_CASE)}) WHERE platform <> 'xx9'""",
    "region_rejects": f"SELECT puuid, platform, league_points FROM ({ladder(PLATFORM_CASE)}) WHERE platform = 'xx9'",
    "timeline_frames": SEATS,
    "pivot_gold": PIVOT,
    "last_minutes": PIVOT_TAIL,
    "gold_by_minute": PIVOT,
    "gold_tail": PIVOT_TAIL,
    "pivot_embeddings": "SELECT vec_id, " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS c{i}" for i in range(64)) + " FROM embeddings",
    "timeline_events": FEED,
    "event_counts": f"SELECT type, count(*) AS n FROM ({HAPPENED}) GROUP BY type",
    "event_counts_by_match": f"SELECT match_id, type, count(*) AS n FROM ({HAPPENED}) GROUP BY match_id, type",
    "event_counts_relational": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "kill_feed": f"SELECT * EXCLUDE (type) FROM ({FEED}) WHERE type = 'CHAMPION_KILL'",
    "kill_feed_head": f"SELECT * EXCLUDE (type) FROM ({FEED}) WHERE type = 'CHAMPION_KILL' ORDER BY match_id, minute, pos LIMIT 20",
    "check_not_null": f"SELECT match_id FROM ({DOUBTFUL}) WHERE duration_seconds IS NULL",
    "check_unique": f"SELECT match_id, count(*) AS n FROM ({DOUBTFUL}) GROUP BY match_id HAVING count(*) > 1",
    "run_checks": f"""
        SELECT *, failures = 0 AS passed FROM (
          SELECT 'not_null' AS test, 'match_id' AS "column", count(*) FILTER (match_id IS NULL) AS failures FROM ({DOUBTFUL})
          UNION ALL SELECT 'not_null', 'duration_seconds', count(*) FILTER (duration_seconds IS NULL) FROM ({DOUBTFUL})
          UNION ALL SELECT 'unique', 'match_id', count(*) FROM (
            SELECT match_id FROM ({DOUBTFUL}) GROUP BY match_id HAVING count(*) > 1))""",
    "checks_by_ingest": f"""
        SELECT *, failures = 0 AS passed FROM (
          SELECT 'not_null' AS test, 'match_id' AS "column", count(*) FILTER (match_id IS NULL) AS failures FROM ({DOUBTFUL})
          UNION ALL SELECT 'not_null', 'duration_seconds', count(*) FILTER (duration_seconds IS NULL) FROM ({DOUBTFUL})
          UNION ALL SELECT 'unique', 'match_id', count(*) FROM (
            SELECT match_id FROM ({DOUBTFUL}) GROUP BY match_id HAVING count(*) > 1))""",
    "snapshot_totals": totals(ladder()),
    "payload_sizes": """
        SELECT doc_id, length(text) // 1024 AS kb, CAST(octet_length(encode(text)) AS BIGINT) AS payload_bytes FROM documents""",
    "storage_summary": shares(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {MEASURE.format(c)} FROM {t}"
        for t, c in (("documents", "text"), ("pages", "html"), ("conversations", "text")))),
    "storage_by_source": shares(f"SELECT source AS table_name, {MEASURE.format('text')} FROM documents GROUP BY source"),
    "land_payloads": """
        SELECT match_id, 'br1' AS platform, TIMESTAMP '2024-02-01 06:00:00' AS fetched_at, CAST(length(payload) AS INTEGER) AS chars,
          sha256(payload) AS payload_sha256 FROM (
          SELECT 'M_' || o_orderkey AS match_id, (
            '{"metadata":{"matchId":"M_' || o_orderkey || '"},"info":{"gameCreation":' || epoch_ms(o_orderdate)
            || ',"gameDuration":' || (o_custkey % 1800 + 900) || ',"queueId":' || CASE o_orderstatus WHEN 'F' THEN 420 ELSE 450 END || ',"mapId":1' || (o_orderkey % 3)
            || ',"gameVersion":"14.' || month(o_orderdate) || '"}}') AS payload FROM orders
          UNION ALL SELECT 'page-' || page_id, html FROM pages)""",
    "landing_rejects": "SELECT page_id FROM pages WHERE page_id % 3 <> 0",
    "page_rejects": "SELECT page_id, 'malformed' AS reason FROM pages",
    "parse_ladder_page": PAGES,
    "append_bronze": """
        SELECT 'matches' AS table_name, count(*) AS written, count(*) AS stored, count(DISTINCT o_orderkey) AS ids FROM orders
        UNION ALL SELECT 'timelines', count(*), count(*), count(DISTINCT conv_id * 10 + turn) FROM conversations""",
    "append_ladder": f"SELECT * REPLACE (fetched_at + INTERVAL 40 DAY AS fetched_at) FROM ({latest(ladder(), 'puuid')})",
    "append_checkpoint": f"SELECT 'acct-' || p_partkey AS puuid, 'br1' AS platform, {AS_OF} AS listed_at FROM part",
    "read_or_empty": f"SELECT match_id FROM ({LISTING})",
    "rebuild_silver": SILVER,
    "refresh_silver": SILVER,
    "refresh_silver_replay": SILVER,
    "unseen_by_index": f"SELECT match_id, account FROM ({LISTING}) WHERE match_id NOT IN ({STORED})",
    "dead_letters": """
        SELECT 'page-' || page_id AS file_path, CASE WHEN page_id % 2 = 0 THEN 'not_json' ELSE 'no_id' END AS reason FROM pages""",
    "stored_summary": shares(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {MEASURE.format('text')} FROM {source}"
        for t, source in (("matches", "documents"), ("timelines", "conversations")))),
    "latest_state": latest(ladder(PLATFORM_CASE), "platform, puuid"),
    "select_cohort_from_state": f"""
        SELECT * FROM (
          SELECT puuid, tier, league_points FROM ({latest(ladder(), 'puuid')}) WHERE tier IN {GOLD_UP}
          ORDER BY puuid LIMIT 60) WHERE puuid NOT IN ({RECENT})""",
    "stream_land": SILVER,
    "crawl_pending": f"""
        SELECT CAST(-1 AS BIGINT) AS batch_no, match_id, pos, pos // 50 AS fetch_no, CAST(pos % 4 AS INTEGER) AS worker FROM (
          SELECT match_id, row_number() OVER (ORDER BY match_id) - 1 AS pos FROM (
            {crawl(NUMBERED, RECENT_LISTING, 900, DEFERRED)})) WHERE 2 * (pos + 1) <= 61""",
    "cohort_crawl_fixed": crawl(
        COHORT_FIXED, f"SELECT * FROM ({TWO_DAYS}) WHERE played_at > {AS_OF} - INTERVAL 24 HOUR", 1_500, FETCH),
    "cohort_crawl": crawl(COHORT_NUMBERED, since_last(24 * 365), 1_500, FETCH),
    "personal_crawl": f"""
        SELECT account, match_id, played_at, queue_id, pos, pos // 50 AS fetch_no, CAST(pos % 4 AS INTEGER) AS worker FROM (
          SELECT *, row_number() OVER (PARTITION BY account ORDER BY played_at DESC, match_id) - 1 AS pos FROM (
            SELECT * FROM (
              SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY CAST(substr(account, 6) AS BIGINT)) AS rn FROM (
                SELECT account, match_id, max(played_at) AS played_at,
                       CAST(arg_max(queue_id, played_at) AS INTEGER) AS queue_id
                FROM ({LISTING}) WHERE match_id NOT IN ({STORED})
                  AND account IN (SELECT 'acct-' || c_custkey FROM customer) GROUP BY account, match_id)) WHERE rn = 1))""",
    "ladder_snapshot": totals(PAGES),
    "lookback_cutoff": f"""
        SELECT event_id, strftime(ts - INTERVAL 24 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') AS since,
               ts > {AS_OF} - INTERVAL 24 HOUR AS recent FROM events""",
}
