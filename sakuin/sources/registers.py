"""Fixed dimensions: prefectures, bureaus and the pages that they publish on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Prefectures.
PREFECTURES = [
    ("01", "北海道"), ("02", "青森県"), ("03", "岩手県"), ("04", "宮城県"), ("05", "秋田県"), ("06", "山形県"), ("07", "福島県"), ("08", "茨城県"), ("09", "栃木県"), ("10", "群馬県"),
    ("11", "埼玉県"), ("12", "千葉県"), ("13", "東京都"), ("14", "神奈川県"), ("15", "新潟県"), ("16", "富山県"), ("17", "石川県"), ("18", "福井県"), ("19", "山梨県"), ("20", "長野県"),
    ("21", "岐阜県"), ("22", "静岡県"), ("23", "愛知県"), ("24", "三重県"), ("25", "滋賀県"), ("26", "京都府"), ("27", "大阪府"), ("28", "兵庫県"), ("29", "奈良県"), ("30", "和歌山県"),
    ("31", "鳥取県"), ("32", "島根県"), ("33", "岡山県"), ("34", "広島県"), ("35", "山口県"), ("36", "徳島県"), ("37", "香川県"), ("38", "愛媛県"), ("39", "高知県"), ("40", "福岡県"),
    ("41", "佐賀県"), ("42", "長崎県"), ("43", "熊本県"), ("44", "大分県"), ("45", "宮崎県"), ("46", "鹿児島県"), ("47", "沖縄県"),
]

# What a section with register lists says, and what sections of other lists say.
TARGET_SECTION = "届出受理医療機関名簿|施設基準.*届出(?:受理)?状況.*全体|施設基準等の届出事項"
EXCLUDED_SECTION = "保険外|届出項目別|主な届出|訪問看護|指定一覧|コード内容別|新規指定|廃止|辞退"
HOST = "https://kouseikyoku.mhlw.go.jp"

# Bureau id, name, page of the monthly lists.
BUREAUS = [
    ("hokkaido", "北海道厚生局", "/hokkaido/gyomu/gyomu/hoken_kikan/todokede_juri_ichiran.html"),
    ("tohoku", "東北厚生局", "/tohoku/gyomu/gyomu/hoken_kikan/documents/201805koushin.html"),
    ("kanto-shinetsu", "関東信越厚生局", "/kantoshinetsu/chousa/kijyun.html"),
    ("tokai-hokuriku", "東海北陸厚生局", "/tokaihokuriku/newpage_00349.html"),
    ("kinki", "近畿厚生局", "/kinki/gyomu/gyomu/hoken_kikan/shitei_jokyo_00004.html"),
    ("chugoku", "中国四国厚生局", "/chugokushikoku/chousaka/shisetsukijunjuri.html"),
    ("shikoku", "四国厚生支局", "/shikoku/gyomu/gyomu/hoken_kikan/shitei/"),
    ("kyushu", "九州厚生局", "/kyushu/gyomu/gyomu/hoken_kikan/index_00007.html"),
]
# Prefectures of each bureau.
BUREAU_PREFECTURES = {
    "hokkaido": ["01"],
    "tohoku": ["02", "03", "04", "05", "06", "07"],
    "kanto-shinetsu": ["08", "09", "10", "11", "12", "13", "14", "15", "19", "20"],
    "tokai-hokuriku": ["16", "17", "21", "22", "23", "24"],
    "kinki": ["18", "25", "26", "27", "28", "29", "30"],
    "chugoku": ["31", "32", "33", "34", "35"],
    "shikoku": ["36", "37", "38", "39"],
    "kyushu": ["40", "41", "42", "43", "44", "45", "46", "47"],
}

# Pages with change notices as (bureau, page, prefecture, pattern of addresses, pattern of contexts).
_NEW_OR_GONE = "新規・変更|失効|辞退"
CHANGE_PAGES = [
    ("hokkaido", "/hokkaido/iryo_shido/shisetsukijyun_jyuri_iryoukikan.html", "01", None, None),
    ("tohoku", "/tohoku/gyomu/gyomu/hoken_kikan/kijun_jurijoukyou.html", None, "(?i)/(?:shinki|jitai)_[^/]+_(?:ika|shika|yakkyoku)_[0-9]{8}\\.pdf\\z", None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/ibaraki/kijun.html", "08", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/tochigi/kijun.html", "09", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/gunma/kijun.html", "10", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/shido_kansa/kijun.html", "11", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/chiba/kijun.html", "12", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/tokyo/kijun.html", "13", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/kanagawa/kijun.html", "14", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/niigata/kijun.html", "15", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/yamanashi/kijun.html", "19", None, None),
    ("kanto-shinetsu", "/kantoshinetsu/gyomu/bu_ka/nagano/kijun.html", "20", None, None),
    ("tokai-hokuriku", "/tokaihokuriku/newpage_00843.html", None, "(?i)-[0-9]{2}-[0-9]{2}-(?:01|03|04)(?:_[0-9]+)?\\.pdf\\z", None),
    ("kinki", "/kinki/gyomu/gyomu/hoken_kikan/kijun_jurijoukyou.html", None, "(?i)todokede(?:juri|sikkou)_[^/]+_(?:ika|sika|yakkyoku)\\.pdf\\z", None),
    ("chugoku", "/chugokushikoku/chousaka/kijunjuriichiran_shinkihenkou_shikkou_00001.html", None, None, _NEW_OR_GONE),
    ("shikoku", "/shikoku/gyomu/gyomu/hoken_kikan/shitei/index_00005.html", None, "(?i)/[0-9]{2}_(?:01|03|04)_01_[0-9]{6}\\.pdf\\z", None),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_fukuoka.html", "40", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_saga.html", "41", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_nagasaki.html", "42", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_kumamoto.html", "43", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_ooita.html", "44", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_miyazaki.html", "45", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_kagoshima.html", "46", None, _NEW_OR_GONE),
    ("kyushu", "/kyushu/gyomu/gyomu/hoken_kikan/juri_okinawa.html", "47", None, _NEW_OR_GONE),
]


def prefectures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PREFECTURES, "code string, name string")


def bureaus(spark: SparkSession) -> DataFrame:
    rows = [(i, n, HOST + p, TARGET_SECTION, EXCLUDED_SECTION) for i, n, p in BUREAUS]
    return spark.createDataFrame(rows, "source_id string, bureau_name string, page_url string, target_section string, excluded_section string")


def change_pages(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Pages with change notices: source_id, bureau_name, page_url, prefecture hint, and patterns that address and context must match."""
    names = {i: n for i, n, _ in BUREAUS}
    rows = [(i, names[i], HOST + p, *more) for i, p, *more in CHANGE_PAGES] if rows is None else rows
    return spark.createDataFrame(rows, "source_id string, bureau_name string, page_url string, prefecture_code_hint string, document_url_pattern string, document_context_pattern string")


def bureau_prefectures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, c) for i, codes in BUREAU_PREFECTURES.items() for c in codes], "source_id string, prefecture_code string")
