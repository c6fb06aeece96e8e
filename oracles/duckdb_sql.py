"""DuckDB twins of the registered queries (the correctness oracle).

Each statement is written from the definition of its output columns: the
stand-in rules are applied to the driver tables row by row, codes and labels
come from small VALUES tables, counts over several periods are filtered
aggregates of one grouping, and a pick of one row per key is the head of an
ordered list.  Nothing is parsed that the rules can compute.
"""

from __future__ import annotations

from encore.functions.dates import days_before
from encore.plans.registry import BUSINESS_DAY, FIRST_DAY, SCORE_DIGITS
from encore.sources.schemas import GAZETTEER_PLACE_COLS, SONG_INT_COLS

DAY = BUSINESS_DAY
YESTERDAY = days_before(DAY, 1)


def _date(day: str) -> str:
    return f"DATE '{day[:4]}-{day[4:6]}-{day[6:]}'"


TODAY = _date(DAY)
_TEXT_DAY = "strftime({}, '%Y%m%d')"
COUNT = "CAST({} AS BIGINT)"


def _query(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# the number of machines is the number of suppliers
FLEET = "fleet AS (SELECT greatest(count(*), 1) AS n FROM supplier)"

# ---------------------------------------------------------------------------- log lines

_ORDINARY = "'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ'"
_SPECIAL = "'MINIK_CLIENT_ADVERTISEMENT_RECORD_REQ'"
_PLAY_COLUMNS = {
    "SONGID": "props ->> '$.k'",
    "MID": "CAST(user_id % n AS VARCHAR)",
    "OPTRATE_TYPE": "event_type",
    "UID": "CAST(user_id AS VARCHAR)",
    "CONSUME_TYPE": "CAST(CAST(event_type = 'purchase' AS INTEGER) AS VARCHAR)",
    "DUR_TIME": "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)",
    "SESSION_ID": "CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d')",
    "SONGNAME": "'song-' || (props ->> '$.k')",
    "PKG_ID": "CAST(user_id % 5 AS VARCHAR)",
    "ORDER_ID": "CAST(event_id AS VARCHAR)",
    "data_dt": "strftime(ts, '%Y%m%d')",
}
_PLAY_SELECT = ", ".join(f"{sql} AS {name}" for name, sql in _PLAY_COLUMNS.items())
DECODED = f"decoded AS (SELECT {_PLAY_SELECT} FROM events, fleet WHERE event_type NOT IN ('signup', 'error'))"
_TAB_ORDER = [c for c in _PLAY_COLUMNS if c != "data_dt"]

# ---------------------------------------------------------------------------- songs

_ints = ",\n  ".join(f"CAST((p_size + {i}) % {i + 2} AS INTEGER) AS {name}" for i, name in enumerate(SONG_INT_COLS))
# by part key modulo 5: the album text; modulo 4: singers named, company
SONGS = f"""albums(r5, pattern) AS (VALUES (0, '{{}}'), (1, '《{{}}》'), (2, NULL), (3, '暂无专辑'), (4, '暂无专辑')),
kinds(r4, named, company) AS (VALUES (0, 2, '{{}} Music'), (1, 1, '乐心曲库'), (2, 1, '乐心曲库'), (3, 0, NULL)),
songs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS NBR,
  p_name || if(p_partkey % 10 = 3, ' (live)', '') AS NAME,
  CAST(p_size % 3 AS INTEGER) AS SOURCE,
  replace(pattern, '{{}}', p_type) AS ALBUM,
  concat('label-', p_brand) AS PRDCT,
  ['国语', '粤语'][p_size % 2 + 1] AS LANG,
  p_type AS VIDEO_FORMAT,
  CAST(p_size * 10 AS INTEGER) AS DUR,
  if(named > 0, concat('singer-', p_partkey % 97), '') AS SINGER1,
  if(named > 1, p_type, '') AS SINGER2,
  if(named > 0, concat(p_partkey % 97), '') AS SINGER1ID,
  if(named > 1, concat(p_size), '') AS SINGER2ID,
  0::INTEGER AS MAC_TIME,
  if(r4 = 0, strftime(make_timestamp(2019, p_size % 12 + 1, 15, 20, 30, 0), '%Y-%m-%d %H:%M:%S'),
     if(r4 = 1, strftime(epoch_ms(1500000000000 + p_partkey * 3600000), '%Y-%m-%d %H:%M:%S'), '')) AS POST_TIME,
  upper(p_name[1]) AS PINYIN_FST,
  p_name AS PINYIN,
  CAST(p_partkey % 2 AS INTEGER) AS SING_TYPE,
  p_brand AS ORI_SINGER,
  concat('lyricist-', p_size % 7) AS LYRICIST,
  concat('composer-', p_size % 5) AS COMPOSER,
  {_ints},
  replace(company, '{{}}', p_brand) AS AUTH_CO,
  CAST(p_size % 2 AS INTEGER) AS STATE,
  if(r4 = 0, concat(p_size, ',', p_size % 7), NULL) AS PRDCT_TYPE
  FROM part JOIN albums ON r5 = p_partkey % 5 JOIN kinds ON r4 = p_partkey % 4)"""

PLAYS = "plays AS (SELECT props ->> '$.k' AS song, user_id AS who, event_id AS id, CAST(ts AS DATE) AS d FROM events)"

# the periods: name of the columns, days back
_PERIODS = {"": 0, "RCT_7_": 7, "RCT_30_": 30}
_MEASURES = {"SING_CNT": "count(*)", "USR_CNT": "count(DISTINCT who)", "ORDR_CNT": "count(DISTINCT id)"}


def _asked(songs: str) -> str:
    """Counts of every asked (song, day) over its periods, and its best days."""
    counts = ",\n    ".join(
        COUNT.format(f"{agg} FILTER (p.d >= a.d - {back})") + f" AS {prefix}{name}"
        for prefix, back in _PERIODS.items() for name, agg in _MEASURES.items())
    return f"""{PLAYS},
asked AS ({songs}),
sung AS (
  SELECT a.song, a.d, {counts}
  FROM asked a JOIN plays p ON p.song = a.song AND p.d BETWEEN a.d - 30 AND a.d GROUP BY a.song, a.d),
heights AS (SELECT song, d, count(*) AS n FROM plays GROUP BY ALL),
best AS (
  SELECT a.song, a.d, {COUNT.format('coalesce(max(n) FILTER (h.d >= a.d - 7), 0)')} AS RCT_7_TOP_SING_CNT,
    {COUNT.format('max(n)')} AS RCT_30_TOP_SING_CNT
  FROM asked a JOIN heights h ON h.song = a.song AND h.d BETWEEN a.d - 30 AND a.d GROUP BY a.song, a.d)"""


_PLAYED_TODAY = f"SELECT DISTINCT song, d FROM plays WHERE d = {TODAY}"
_PLAYED_ANY_DAY = f"SELECT DISTINCT song, d FROM plays WHERE d BETWEEN {_date(FIRST_DAY)} AND {TODAY}"
_PLAYED_LATELY = f"SELECT DISTINCT song, {TODAY} AS d FROM plays WHERE d BETWEEN {TODAY} - 30 AND {TODAY}"

_SONG_FIELDS = ["NAME", "SOURCE", "ALBUM", "PRDCT", "LANG", "VIDEO_FORMAT", "DUR", "SINGER1", "SINGER2", "SINGER1ID", "SINGER2ID", "MAC_TIME"]
_LIKES = ["SUPP_CNT", "RCT_7_SUPP_CNT", "RCT_7_TOP_SUPP_CNT", "RCT_30_SUPP_CNT", "RCT_30_TOP_SUPP_CNT"]


def _features(songs: str) -> str:
    measured = [f"{p}{m}" for p in _PERIODS for m in _MEASURES] + ["RCT_7_TOP_SING_CNT", "RCT_30_TOP_SING_CNT"]
    likes = ", ".join(f"0::BIGINT AS {c}" for c in _LIKES)
    return f"""{_asked(songs)},
{SONGS},
features AS (
  SELECT NBR, {', '.join(_SONG_FIELDS)}, {', '.join(measured)}, {likes}, {_TEXT_DAY.format('sung.d')} AS data_dt
  FROM sung JOIN best USING (song, d) JOIN songs ON NBR = song)"""


def _index(sung: str, best: str | None, days: int) -> str:
    """Popularity: nobody likes a song here, so its 20 percent add nothing."""
    if best is None:
        return f"10 * pow(0.63 * 0.8 * ln({sung} + 1), 2)"
    return f"10 * pow((0.63 * ln({sung} / {days} + 1) + 0.37 * ln({best} + 1)) * 0.8, 2)"


def _charts(source: str, names: list[str]) -> str:
    """One row per period, ranked by index, then names."""
    entries = ", ".join(
        f"{{'p': '{days}', 'v': {_index(sung, best, days)}}}"
        for days, sung, best in ((1, "SING_CNT", None), (7, "RCT_7_SING_CNT", "RCT_7_TOP_SING_CNT"), (30, "RCT_30_SING_CNT", "RCT_30_TOP_SING_CNT")))
    listed = ", ".join(names)
    return f"""entries AS (SELECT {listed}, data_dt, unnest([{entries}]) AS e FROM {source}),
charts AS (
  SELECT e.p AS PERIOD, {listed}, round(e.v, {SCORE_DIGITS}) AS RSI, data_dt,
    CAST(row_number() OVER (PARTITION BY data_dt, e.p ORDER BY e.v DESC, {listed}) AS INTEGER) AS RSI_RANK
  FROM entries)"""


_SUMMED = [c for p in ("", "RCT_7_", "RCT_7_TOP_", "RCT_30_", "RCT_30_TOP_") for c in (f"{p}SING_CNT",)]
SINGERS = f"""singers AS (
  SELECT SINGER1ID, SINGER1, data_dt, {', '.join(f'sum({c}) AS {c}' for c in _SUMMED)} FROM features GROUP BY ALL)"""

_song_charts = (_features(_PLAYED_TODAY), _charts("features", ["NBR", "NAME"]))
_singer_charts = (_features(_PLAYED_TODAY), SINGERS, _charts("singers", ["SINGER1ID", "SINGER1"]))
_lately = ["SING_CNT", "USR_CNT", "ORDR_CNT", "RCT_7_SING_CNT", "RCT_7_TOP_SING_CNT", "RCT_7_USR_CNT", "RCT_7_ORDR_CNT",
           "RCT_30_SING_CNT", "RCT_30_TOP_SING_CNT", "RCT_30_USR_CNT", "RCT_30_ORDR_CNT"]

ORACLES: dict[str, str] = {
    "log_split_filter": f"""SELECT {_TEXT_DAY.format('ts')} AS data_dt, {COUNT.format("count_if(event_type != 'error')")} AS kept,
  {COUNT.format("count_if(event_type = 'error')")} AS dropped FROM events GROUP BY 1""",
    "log_demux_counts": f"""SELECT {_TEXT_DAY.format('ts')} AS data_dt, if(event_type = 'signup', {_SPECIAL}, {_ORDINARY}) AS req_type,
  count(*) AS n_lines FROM events WHERE event_type != 'error' GROUP BY ALL""",
    "play_decode": _query(FLEET, DECODED, body="SELECT * FROM decoded"),
    "play_tab_text": _query(FLEET, DECODED, body=f"SELECT concat_ws(chr(9), {', '.join(_TAB_ORDER)}) AS value, data_dt FROM decoded"),
    "catalog_clean": _query(SONGS, body="FROM songs"),
    "song_horizons": _query(_asked(_PLAYED_LATELY), body=f"SELECT song AS SONGID, {', '.join(_lately)} FROM sung JOIN best USING (song, d)"),
    "song_features": _query(_features(_PLAYED_TODAY), body="FROM features"),
    "song_features_all_days": _query(_features(_PLAYED_ANY_DAY), body="FROM features"),
    "song_rsi": _query(*_song_charts, body="FROM charts"),
    "song_rsi_top30": _query(*_song_charts, body="FROM charts WHERE RSI_RANK <= 30"),
    "song_rsi_all_days": _query(_features(_PLAYED_ANY_DAY), _charts("features", ["NBR", "NAME"]), body="FROM charts"),
    "singer_rsi": _query(*_singer_charts, body="FROM charts"),
    "singer_rsi_top30": _query(*_singer_charts, body="FROM charts WHERE RSI_RANK <= 30"),
    "song_day": _query(PLAYS, body=f"""SELECT {_TEXT_DAY.format('d')} AS data_dt, song AS NBR, count(*) AS SING_CNT, 0::BIGINT AS SUPP_CNT,
  count(DISTINCT who) AS USR_CNT, count(DISTINCT id) AS ORDR_CNT FROM plays GROUP BY song, d"""),
    "song_tops": _query(_asked(_PLAYED_LATELY), body="""SELECT song AS NBR, RCT_7_TOP_SING_CNT, 0::BIGINT AS RCT_7_TOP_SUPP_CNT,
  RCT_30_TOP_SING_CNT, 0::BIGINT AS RCT_30_TOP_SUPP_CNT FROM best"""),
}

# ---------------------------------------------------------------------------- orders and users

# order status, and whether the key is odd, to the kind of order and of abnormality
ORDERS = f"""{FLEET},
outcome(status, odd, kind) AS (VALUES ('F', 0, 0), ('F', 1, 0), ('P', 0, 1), ('P', 1, 1), ('O', 0, 2), ('O', 1, 2)),
bought AS (
  SELECT concat(o_orderkey) AS ID, concat('T', o_orderkey) AS TRD_ID, concat(o_custkey) AS UID, concat(o_custkey % n) AS MID,
    '2' AS PRDCD_TYPE, o_orderpriority AS PAY_TYPE,
    strftime(make_timestamp(2024, 1, day(o_orderdate), o_orderkey % 24, 0, 0), '%Y%m%d%H%M%S') AS ACT_TM,
    if(o_orderkey % 11 = 0, NULL, concat(o_orderkey % 3)) AS PKG_ID,
    CAST(round(o_totalprice * 100) AS BIGINT) AS COIN_PRC, 1::INTEGER AS COIN_CNT, concat(o_orderkey) AS ORDR_ID,
    if(o_orderkey % 4 = 0, 'new-year', NULL) AS ACTV_NM, 0::BIGINT AS PKG_DSCNT, concat(o_orderkey % 2) AS CPN_TYPE,
    kind::INTEGER AS ABN_TYP, strftime(make_date(2024, 1, day(o_orderdate)), '%Y%m%d') AS data_dt
  FROM orders, fleet JOIN outcome ON status = o_orderstatus AND odd = o_orderkey % 2)"""


def _money_by(kind: int, users: str, word: str) -> str:
    return _query(ORDERS, body=f"""SELECT data_dt, MID, PKG_ID, PAY_TYPE, count(DISTINCT UID) AS {users},
  {COUNT.format('sum(COIN_PRC * COIN_CNT)')} AS TOT_{word}, count(ORDR_ID) AS {word}_ORDR_CNT FROM bought WHERE ABN_TYP = {kind} GROUP BY ALL""")


# market segment to channel; how its users log on and score; what it knows of them
USERS = f"""{FLEET},
channels(segment, code, prefix, app, checked) AS (VALUES ('AUTOMOBILE', '1', 'wx_', false, false), ('BUILDING', '2', 'ali_', false, true),
  ('FURNITURE', '3', 'qq_', false, false), ('MACHINERY', '4', 'app_', true, false), ('HOUSEHOLD', '4', 'app_', true, false)),
people AS (
  SELECT concat(c_custkey) AS UID, concat(c_custkey % n) AS REG_MID, code AS REG_CHNL, concat(prefix, c_custkey) AS REF_UID,
    if(c_custkey % 7 = 6, NULL, concat(c_nationkey % 3)) AS GDR,
    concat(1970 + c_custkey % 30, '-0', 1 + c_custkey % 9, '-1', c_custkey % 10) AS BIRTHDAY,
    concat('138', 10000000 + c_custkey) AS MSISDN, concat(c_nationkey) AS LOC_ID, if(app, NULL, concat(c_custkey % 3)) AS LOG_MDE,
    strftime(DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER), '%Y%m%d') AS REG_DT,
    concat(printf('%02d', c_custkey % 24), '1500') AS REG_TM,
    CAST(c_custkey % 1000 AS INTEGER) AS USR_EXP, CAST(if(app, 0, c_nationkey * 10) AS INTEGER) AS SCORE, CAST(1 + c_custkey % 5 AS INTEGER) AS LEVEL,
    if(checked AND c_custkey % 3 = 1, '1', '2') AS USR_TYPE,
    if(checked, concat((c_custkey + 1) % 2), NULL) AS IS_CERT, if(checked, if(c_custkey % 5 = 0, '1', '0'), NULL) AS IS_STDNT
  FROM customer, fleet JOIN channels ON segment = c_mktsegment)"""
SEEN = "seen AS (SELECT DISTINCT concat(user_id) AS UID, CAST(ts AS DATE) AS d FROM events)"
SEEN_PEOPLE = f"""{USERS},
{SEEN},
visits AS (SELECT seen.UID, people.* EXCLUDE (UID), {_TEXT_DAY.format('d')} AS data_dt, d FROM seen LEFT JOIN people USING (UID))"""
LABELS = """channel_names(code, label) AS (VALUES ('1', '微信'), ('2', '支付宝'), ('3', 'QQ'), ('4', 'APP')),
gender_names(code, label) AS (VALUES ('1', '男'), ('2', '女')),
often AS (SELECT UID, d, count(*) OVER (PARTITION BY UID ORDER BY d RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS days FROM seen),
listed AS (
  SELECT v.UID, coalesce(c.label, '未知') AS REG_CHNL, REF_UID, coalesce(g.label, '不明') AS GDR, BIRTHDAY, MSISDN, REG_DT,
    CAST(LEVEL AS DOUBLE) AS LEVEL, data_dt
  FROM visits v JOIN often o ON o.UID = v.UID AND o.d = v.d AND days = 7
  LEFT JOIN channel_names c ON c.code = REG_CHNL LEFT JOIN gender_names g ON g.code = GDR)"""
_ARRIVALS = "SELECT REG_MID AS MID, count(UID) AS NEW_USR_CNT{} FROM visits WHERE REG_DT = data_dt{} GROUP BY ALL"

ORACLES.update({
    "consumption_brief": _query(ORDERS, body="""SELECT ID, TRD_ID, UID, MID, PRDCD_TYPE, PAY_TYPE, ACT_TM, PKG_ID, COIN_PRC, COIN_CNT,
  ACT_TM AS UPDATE_TM, ORDR_ID, ACTV_NM, COIN_PRC AS PKG_PRC, PKG_DSCNT, CPN_TYPE, ABN_TYP, data_dt FROM bought"""),
    "revenue_by_machine": _money_by(0, "CNSM_USR_CNT", "REV"),
    "refund_by_machine": _money_by(2, "REF_USR_CNT", "REF"),
    "user_union": _query(USERS, body="FROM people"),
    "active_profile": _query(SEEN_PEOPLE, body="""SELECT * EXCLUDE (d) REPLACE (USR_EXP::DOUBLE AS USR_EXP, SCORE::DOUBLE AS SCORE,
  LEVEL::DOUBLE AS LEVEL) FROM visits"""),
    "active_list": _query(SEEN_PEOPLE, LABELS, body=f"SELECT * EXCLUDE (data_dt) FROM listed WHERE data_dt = '{DAY}'"),
    "active_list_all_days": _query(SEEN_PEOPLE, LABELS, body=f"FROM listed WHERE data_dt BETWEEN '{FIRST_DAY}' AND '{DAY}'"),
    "new_users": _query(SEEN_PEOPLE, body=_ARRIVALS.format("", f" AND data_dt = '{DAY}'")),
    "new_users_all_days": _query(SEEN_PEOPLE, body=_ARRIVALS.format(", data_dt", "")),
    "null_text_clean": _query(FLEET, body="""SELECT concat(c_custkey) AS UID, if(c_custkey % 7 = 6, NULL, concat(c_nationkey % 3)) AS GDR,
  if(c_custkey % 5 IN (1, 2), NULL, c_name) AS NAME, if(c_custkey % 4 = 3, NULL, concat(c_custkey % n)) AS REG_MID FROM customer, fleet"""),
})

# ---------------------------------------------------------------------------- machines

# province and city that the rules read from the address of each nation, by hand
PARSED = [
    ("山西省太原市小店区", "山西", "太原"), ("北京市朝阳区", "北京", "朝阳"), ("重庆市城口县", "重庆", "城口"),
    ("内蒙古自治区包头市", "内蒙古", "包头"), ("新疆维吾尔自治区伊犁哈萨克自治州", "新疆", "伊犁哈萨克自治"),
    ("四川省甘孜州", "四川", "甘孜"), ("西藏自治区拉萨市", "西藏", "拉萨"), ("上海市浦东新区", "上海", "浦东新"),
    ("天津市和平区", "天津", "和平"), ("广西壮族自治区南宁市青秀区", "广西", "南宁"), ("宁夏回族自治区银川市兴庆区", "宁夏", "银川"),
    ("广东省深圳市南山区", "广东", "深圳"), ("浙江省杭州市西湖区", "浙江", "杭州"), ("江西省南昌市红谷滩区", "江西", "南昌"),
    ("湖北省武汉市洪山区", "湖北", "武汉"), ("重庆市渝中区", "重庆", "渝中"), ("新疆维吾尔自治区乌鲁木齐市天山区", "新疆", "乌鲁木齐"),
    ("江苏省南京市鼓楼区", "江苏", "南京"), ("香港特别行政区", "", ""), ("福建省厦门市思明区", "福建", "厦门"),
    ("湖南省长沙市岳麓区", "湖南", "长沙"), ("云南省大理白族自治州", "云南", "大理白族自治"), ("山东省青岛市市南区", "山东", "青岛"),
    ("河南省郑州市金水区", "河南", "郑州"), ("吉林省延边朝鲜族自治州", "吉林", "延边朝鲜族自治"),
]
_parsed = ", ".join(f"({i}, '{a}', '{p}', '{c}')" for i, (a, p, c) in enumerate(PARSED))
_NEVER = "19700101000000"
# one row per supplier: who knows the machine, and all that is said of it
FLEET_ROWS = f"""parsed(nation, raw, province, city) AS (VALUES {_parsed}),
machines AS (
  SELECT s_suppkey AS k, concat(s_suppkey) AS MID, s_name, s_acctbal, s_nationkey AS nk, raw, province, city,
    k % 10 != 3 AS in_a, k % 10 != 7 AS in_b, k % 8 != 6 AS in_store,
    if(k % 5 <= 1, '江西', province) AS own_province, if(k % 5 IN (0, 2), '南昌', city) AS own_city,
    if(k % 7 = 0, NULL, concat(raw, '-', k)) AS own_address,
    ['20230105093000', '20230105000000', '{_NEVER}'][k % 3 + 1] AS revised,
    ['20221201000000', '{_NEVER}', '20221201120000', '20221201120000'][k % 4 + 1] AS sold,
    ['20230301101010', '20230301000000', '{_NEVER}'][k % 3 + 1] AS activated,
    ['20230201000000', '20230201090000'][k % 2 + 1] AS ordered,
    k % 11 != 5 AND own_province != '' AND own_city != '' AS placed
  FROM supplier JOIN parsed ON nation = s_nationkey)"""


def _if(flag: str, value: str) -> str:
    return f"if({flag}, {value}, NULL)"


_scene = {"STORE_NM": "'store-' || here.n_name", "SCENCE_CATGY": "['KTV', 'Mall'][here.n_regionkey % 2 + 1]", "SCENE": "concat('tag-', here.n_regionkey)",
          "SUB_SCENCE_CATGY": "concat('catgy-', nk % 3)", "SUB_SCENE": "concat('scene-', nk % 4)", "BRND": "concat('brand-', here.n_regionkey)",
          "SUB_BRND": "concat('sub-brand-', nk)"}
_profile = {
    "MID": "MID", "MAC_NM": _if("in_b", "'KTV-' || MID"), "SONG_WHSE_VER": _if("in_a", "concat('S', nk)"), "EXEC_VER": _if("in_a", "concat('E', k % 3)"),
    "UI_VER": _if("in_a", "'U1'"), "HARD_ID": _if("in_a", "'HW' || MID"), "SALE_TM": _if("placed", "sold"), "REV_TM": _if("placed", "revised"),
    "OPER_NM": _if("in_store", _scene["STORE_NM"]), "PRVC": f"coalesce({_if('placed', 'own_province')}, {_if('in_b', 'r_name')})",
    "CTY": f"coalesce({_if('placed', 'own_city')}, {_if('in_b', 'here.n_name')})", "AREA": _if("in_b", "next.n_name || '-district'"),
    "ADDR": f"coalesce({_if('placed', 'own_address')}, {_if('in_b AND k % 10 != 0', 'concat(' + repr('No.') + ', k, ' + repr(' Jiefang Rd ') + ', s_name)')})",
    **{c: _if("in_store", v) for c, v in _scene.items()},
    "PRDCT_NM": _if("in_b", "if(k % 5 = 0, '联营版', '标准版')"), "PRDCT_TYP": "2::INTEGER",
    "BUS_MODE": "if(in_b AND (k % 5 = 0 OR k * 7 % 150 < 100), '联营', '卖断')",
    "INV_RATE": _if("in_b", "CAST(k * 7 % 150 AS DOUBLE)"), "AGE_RATE": _if("in_b", "CAST(k % 10 AS DOUBLE)"), "COM_RATE": _if("in_b", "20::DOUBLE"),
    "PAR_RATE": _if("in_b AND k % 9 != 0", "CAST(k % 3 AS DOUBLE)"),
    "IS_ACTV": "if(in_a, if(s_acctbal >= 0, '1', '0'), " + _if("in_b", "concat((k + 1) % 2)") + ")",
    "ACTV_TM": _if("in_b", "activated"), "PAY_SW": "if(in_a, concat((k + 1) % 2), " + _if("in_b", "if(k % 3 = 0, '0', '1')") + ")",
    "PRTN_NM": _if("in_store", _scene["STORE_NM"]), "CUR_LOGIN_TM": _if("in_a", "concat('202401', printf('%02d', k % 30 + 1), '083000')"),
}
PROFILES = f"""{FLEET_ROWS},
profiles AS (
  SELECT {', '.join(f'{v} AS {c}' for c, v in _profile.items())}, '{DAY}' AS data_dt
  FROM machines JOIN nation here ON here.n_nationkey = nk
  JOIN nation next ON next.n_nationkey = (nk + 1) % 25 JOIN region ON r_regionkey = nk % 5
  WHERE in_a OR in_b)"""

# ---------------------------------------------------------------------------- locations

_thousandths = "concat(({0}) // 1000, '.', printf('%03d', ({0}) % 1000))"
_spot = "{low} + (m * {step} + if(user_id % 7 = 0, 11, 0)) % {span}"
REPORTS = f"""{FLEET},
reports AS (
  SELECT concat(user_id) AS UID, m, concat(m) AS MID, CAST(ts AS DATE) AS d, event_type = 'error' AND event_id % 4 = 0 AS empty,
    if(empty, '', CASE WHEN m % 50 = 7 THEN '-' || {_thousandths.format('m * 37 % 60000')} WHEN m % 41 = 5 THEN 'north'
      WHEN m % 43 = 9 THEN '123.4' ELSE {_thousandths.format(_spot.format(low=18000, step=7919, span=36000))} END) AS X,
    if(empty, '', CASE WHEN m % 50 = 7 THEN '-' || {_thousandths.format('m * 53 % 170000')}
      ELSE {_thousandths.format(_spot.format(low=73000, step=6007, span=62000))} END) AS Y
  FROM (SELECT *, event_id % (n * 20) AS m FROM events, fleet))"""
_named = {
    "ADDR": "r_name || ' ' || n_name", "PRVC": "r_name", "CTY": "n_name", "CTY_CD": "concat(n_nationkey)", "DISTRICT": "n_name || '-D'",
    "AD_CD": "concat(100000 + n_nationkey)", "TOWN_SHIP": "concat('town-', n_nationkey % 4)", "TOWN_CD": "concat(n_nationkey * 1000)",
    "NB_NM": "concat('nb-', c_custkey)", "NB_TP": "'residential'", "BD_NM": "concat('bd-', n_nationkey)", "BD_TP": "'mall'",
    "STREET": "n_name || ' Street'", "STREET_NB": "concat(n_nationkey % 9 + 1)", "STREET_LOC": "concat(n_nationkey)", "STREET_DRCTION": "'N'",
    "STREET_DSTANCE": "concat(n_nationkey * 10)", "BUS_INFO": "'[]'",
}
PLACES = f"""places AS (
  SELECT c_custkey AS id, CAST({_thousandths.format('18000 + c_custkey * 7577 % 36000')} AS DOUBLE) AS lat,
    CAST({_thousandths.format('73000 + c_custkey * 9973 % 62000')} AS DOUBLE) AS lng, {', '.join(f'{_named[c]} AS {c}' for c in GAZETTEER_PLACE_COLS)}
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def _favourites(days: list[str], blanks: bool = True) -> str:
    """Each machine's most reported spot of the 31 days that end on a day."""
    asked = ", ".join(f"({_date(d)})" for d in days)
    first = "" if blanks else " WHERE X != '' AND Y != ''"
    return f"""{REPORTS},
days(day) AS (VALUES {asked}),
votes AS (SELECT day, MID, X, Y, count(DISTINCT UID) AS n FROM reports JOIN days ON d BETWEEN day - 30 AND day{first} GROUP BY ALL),
chosen AS (SELECT day, MID, (list({{'X': X, 'Y': Y, 'n': n}} ORDER BY n DESC, X, Y))[1] AS c FROM votes GROUP BY ALL),
favourites AS (SELECT day, MID, c.X AS X, c.Y AS Y, CAST(c.n AS INTEGER) AS CNT FROM chosen WHERE c.X != '' AND c.Y != '')"""


MONTH = [f"{int(FIRST_DAY) + i}" for i in range(int(DAY) - int(FIRST_DAY) + 1)]
LOCATED = f"""{PLACES},
points AS (SELECT DISTINCT X, Y, try_cast(X AS DOUBLE) AS lat, try_cast(Y AS DOUBLE) AS lng FROM favourites),
nearest AS (
  SELECT X, Y, min({{'d': 2 * 6371.0088 * asin(least(1, sqrt(pow(sin((radians(q.lat) - radians(p.lat)) / 2), 2)
      + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin((radians(q.lng) - radians(p.lng)) / 2), 2)))), 'id': id}}).id AS id
  FROM points p, places q WHERE p.lat BETWEEN -90 AND 90 AND p.lng BETWEEN -180 AND 180 GROUP BY X, Y),
located AS (
  SELECT day, MID, X, Y, CNT, {', '.join(f"coalesce({c}, '') AS {c}" for c in GAZETTEER_PLACE_COLS)}
  FROM favourites LEFT JOIN nearest USING (X, Y) LEFT JOIN places USING (id))"""
LATEST = f"""{_favourites([DAY, YESTERDAY])},
{LOCATED},
latest AS (SELECT DISTINCT ON (MID) * EXCLUDE (day), '{DAY}' AS data_dt FROM located ORDER BY MID, day DESC)"""

# ---------------------------------------------------------------------------- revenue


def _renamed(ctes: str) -> str:
    """The shared parts name the fleet once."""
    return ctes.replace(f"{FLEET},\n", "")


def _statement(both: bool) -> str:
    """One row per machine and paid group.  Refunds belong to a revenue group
    when package and pay type are known; with ``both`` every group counts."""
    shown = "true" if both else "PKG_ID IS NOT NULL AND PAY_TYPE IS NOT NULL"
    rows = "true" if both else "paid > 0"
    money = [("CNSM_USR_CNT", "payers", "true"), ("REF_USR_CNT", "returners", shown), ("REV_ORDR_CNT", "paid", "true"),
             ("REF_ORDR_CNT", "returned", shown), ("TOT_REV", "revenue", "true"), ("TOT_REF", "refunds", shown)]
    kept = ["MID", "MAC_NM", "PRDCT_TYP", "STORE_NM", "BUS_MODE", "PAY_SW", "SCENCE_CATGY", "SUB_SCENCE_CATGY", "SCENE", "SUB_SCENE", "BRND",
            "SUB_BRND", "INV_RATE", "AGE_RATE", "COM_RATE", "PAR_RATE"]
    of = "FILTER (ABN_TYP = {})"
    return f"""{ORDERS},
{_renamed(SEEN_PEOPLE)},
{PROFILES},
{_renamed(LATEST)},
arrivals AS ({_ARRIVALS.format('', f" AND data_dt = '{DAY}'")}),
groups AS (
  SELECT MID, PKG_ID, PAY_TYPE, count(DISTINCT UID) {of.format(0)} AS payers, count(DISTINCT UID) {of.format(2)} AS returners,
    count(*) {of.format(0)} AS paid, count(*) {of.format(2)} AS returned,
    sum(COIN_PRC) {of.format(0)} AS revenue, sum(COIN_PRC) {of.format(2)} AS refunds
  FROM bought WHERE data_dt = '{DAY}' AND ABN_TYP IN (0, 2) GROUP BY ALL),
statement AS (
  SELECT {', '.join('p.' + c for c in kept)}, coalesce(l.PRVC, p.PRVC) AS PRVC, coalesce(l.CTY, p.CTY) AS CTY, coalesce(l.DISTRICT, p.AREA) AS AREA,
    PRTN_NM AS AGE_ID, PKG_ID, PAY_TYPE, {', '.join(COUNT.format(f'coalesce(if({when}, {src}, 0), 0)') + f' AS {c}' for c, src, when in money)},
    {COUNT.format('coalesce(NEW_USR_CNT, 0)')} AS NEW_USR_CNT, '{DAY}' AS data_dt
  FROM profiles p LEFT JOIN latest l ON l.MID = p.MID LEFT JOIN (FROM groups WHERE {rows}) g ON g.MID = p.MID
  LEFT JOIN arrivals a ON a.MID = p.MID)"""


def _money(expr: str) -> str:
    return f"CAST(CAST(sum({expr}) AS DECIMAL(18, 4)) AS DOUBLE)"


_summed = ", ".join(f"{COUNT.format(f'sum({c})')} AS {{}}{c}" for c in ("REV_ORDR_CNT", "REF_ORDR_CNT", "CNSM_USR_CNT", "REF_USR_CNT"))
_shares = ", ".join(f"{_money(f'TOT_REV * coalesce({r}_RATE, 0)')} AS TOT_{r}_REV" for r in ("INV", "AGE", "COM", "PAR"))
_b_times = "SELECT MID, 'B' AS system, activated AS T1, ordered AS T2 FROM machines"

ORACLES.update({
    "machine_ids": _query(FLEET_ROWS, body="SELECT MID FROM machines WHERE in_a OR in_b"),
    "address_parse": _query(FLEET_ROWS, body="SELECT MID, raw AS ADDR, province AS PRVC, city AS CTY FROM machines"),
    "time14_clean": _query(FLEET_ROWS, body=f"SELECT MID, 'A' AS system, revised AS T1, sold AS T2 FROM machines UNION ALL {_b_times}"),
    "machine_locations_clean": _query(FLEET_ROWS, body="""SELECT MID, own_province AS PRVC, own_city AS CTY, own_address AS ADDR_FMT,
  revised AS REV_TM, sold AS SALE_TM FROM machines WHERE own_province != '' AND own_city != ''"""),
    "machine_profile": _query(PROFILES, body="FROM profiles"),
    "machine_mode_location": _query(_favourites([DAY]), body="SELECT * EXCLUDE (day) FROM favourites"),
    "machine_mode_location_nonblank": _query(_favourites([DAY], blanks=False), body="SELECT * EXCLUDE (day) FROM favourites"),
    "place_lookup": _query(_favourites([DAY]), LOCATED, body="SELECT * EXCLUDE (day) FROM located"),
    "location_rollforward": _query(LATEST, body="FROM latest"),
    "location_all_days": _query(_favourites(MONTH), LOCATED, body=f"""SELECT l.* EXCLUDE (day), {_TEXT_DAY.format('today.day')} AS data_dt
FROM days today JOIN located l ON l.day <= today.day
QUALIFY row_number() OVER (PARTITION BY today.day, MID ORDER BY l.day DESC) = 1"""),
    "machine_stat": _query(_statement(False), body="FROM statement"),
    "machine_stat_refunds": _query(_statement(True), body="FROM statement"),
    "region_stat": _query(_statement(False), body=f"""SELECT PRVC, CTY, count(MID) AS MAC_CNT, count(DISTINCT MID) AS MAC_DISTINCT_CNT,
  {_money('TOT_REV')} AS MAC_REV, {_money('TOT_REF')} AS MAC_REF, {_summed.format(*['MAC_'] * 4)}, '{DAY}' AS data_dt FROM statement GROUP BY PRVC, CTY"""),
    "merchant_share": _query(_statement(False), body=f"""SELECT AGE_ID AS ADMIN_ID, PAY_TYPE, {COUNT.format('sum(REV_ORDR_CNT)')} AS REV_ORDR_CNT,
  {COUNT.format('sum(REF_ORDR_CNT)')} AS REF_ORDR_CNT, CAST(sum(TOT_REV) AS DOUBLE) AS TOT_REV, CAST(sum(TOT_REF) AS DOUBLE) AS TOT_REF,
  {_shares}, '{DAY}' AS data_dt FROM statement GROUP BY AGE_ID, PAY_TYPE"""),
})

# ---------------------------------------------------------------------------- sliding windows

_START = "epoch_us(TIMESTAMP '2024-01-01 00:00:00')"
RECORDS = f"""{FLEET},
records AS (
  SELECT {_START} + (epoch_us(ts) - {_START}) // 3600 AS t, concat(user_id % n) AS mid, if(event_id % 23 = 0, NULL, concat(user_id)) AS uid,
    props ->> '$.k' AS songid, 'song-' || (props ->> '$.k') AS songname
  FROM events, fleet)"""


def _opened(rows: str, seconds: int, slide: int) -> str:
    """Every row once per window that is open at its time ``t``."""
    return f"""opened AS (
  SELECT *, make_timestamp(start) AS window_start, make_timestamp(start + {seconds * 10**6}) AS window_end
  FROM (SELECT *, (t // {slide * 10**6} - unnest(range({seconds // slide}))) * {slide * 10**6} AS start FROM {rows}))"""


_BY = "window_start, window_end, mid"
ORACLES.update({
    "pv_sliding": _query(RECORDS, _opened("records", 60, 5), body=f"SELECT {_BY}, count(*) AS pv FROM opened GROUP BY ALL"),
    "uv_exact": _query(RECORDS, _opened("records", 60, 5), body=f"SELECT {_BY}, count(DISTINCT uid) AS uv FROM opened GROUP BY ALL"),
    "pv_uv": _query(RECORDS, _opened("records", 60, 5), body=f"SELECT {_BY}, count(*) AS pv, count(DISTINCT uid) AS uv FROM opened GROUP BY ALL"),
    "uv_batch5s": _query(RECORDS, "buckets AS (SELECT DISTINCT t // 5000000 * 5000000 AS t, mid, uid FROM records)", _opened("buckets", 60, 5),
                         body=f"SELECT {_BY}, count(uid) AS uv FROM opened GROUP BY ALL"),
    "hot_songs": _query(RECORDS, _opened("records", 60, 20), "tally AS (SELECT window_start, window_end, songname, count(*) AS times FROM opened GROUP BY ALL)",
                        body="""SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY times DESC, songname) AS INTEGER) AS rank
FROM tally QUALIFY rank <= 30"""),
    "record_parse": _query(RECORDS, body=f"""SELECT date_trunc('minute', make_timestamp(t)) AS minute, count_if(whole) AS kept,
  count(if(whole, uid, NULL)) AS with_user, {COUNT.format('coalesce(sum(length(songname)) FILTER (whole), 0)')} AS name_chars,
  count_if(NOT whole) AS malformed FROM (SELECT *, songid::BIGINT % 19 != 7 AS whole FROM records) GROUP BY 1"""),
})
