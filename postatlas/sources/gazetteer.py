"""The gazetteer: a small constant table of places."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (names, latitude, longitude, label, prefecture, kind), in an order that decides ties.
PLACES = (
    (("北海道", "Hokkaido", "Hokkaidō",), 43.06, 141.35, "北海道", "北海道", "pref"),
    (("青森県", "青森", "Aomori",), 40.82, 140.74, "青森県", "青森県", "pref"),
    (("岩手県", "岩手", "Iwate",), 39.70, 141.15, "岩手県", "岩手県", "pref"),
    (("宮城県", "宮城", "Miyagi",), 38.27, 140.87, "宮城県", "宮城県", "pref"),
    (("秋田県", "秋田", "Akita",), 39.72, 140.10, "秋田県", "秋田県", "pref"),
    (("山形県", "山形", "Yamagata",), 38.24, 140.36, "山形県", "山形県", "pref"),
    (("福島県", "福島", "Fukushima",), 37.75, 140.47, "福島県", "福島県", "pref"),
    (("茨城県", "茨城", "Ibaraki",), 36.34, 140.45, "茨城県", "茨城県", "pref"),
    (("栃木県", "栃木", "Tochigi",), 36.57, 139.88, "栃木県", "栃木県", "pref"),
    (("群馬県", "群馬", "Gunma",), 36.39, 139.06, "群馬県", "群馬県", "pref"),
    (("埼玉県", "埼玉", "Saitama",), 35.86, 139.65, "埼玉県", "埼玉県", "pref"),
    (("千葉県", "千葉", "Chiba",), 35.61, 140.12, "千葉県", "千葉県", "pref"),
    (("東京都", "東京", "Tokyo", "Tōkyō",), 35.69, 139.69, "東京都", "東京都", "pref"),
    (("神奈川県", "神奈川", "Kanagawa",), 35.45, 139.64, "神奈川県", "神奈川県", "pref"),
    (("新潟県", "新潟", "Niigata",), 37.90, 139.02, "新潟県", "新潟県", "pref"),
    (("富山県", "富山", "Toyama",), 36.70, 137.21, "富山県", "富山県", "pref"),
    (("石川県", "石川", "Ishikawa",), 36.59, 136.63, "石川県", "石川県", "pref"),
    (("福井県", "福井", "Fukui",), 36.07, 136.22, "福井県", "福井県", "pref"),
    (("山梨県", "山梨", "Yamanashi",), 35.66, 138.57, "山梨県", "山梨県", "pref"),
    (("長野県", "長野", "Nagano",), 36.65, 138.18, "長野県", "長野県", "pref"),
    (("岐阜県", "岐阜", "Gifu",), 35.39, 136.72, "岐阜県", "岐阜県", "pref"),
    (("静岡県", "静岡", "Shizuoka",), 34.98, 138.38, "静岡県", "静岡県", "pref"),
    (("愛知県", "愛知", "Aichi",), 35.18, 136.91, "愛知県", "愛知県", "pref"),
    (("三重県", "三重", "Mie",), 34.73, 136.51, "三重県", "三重県", "pref"),
    (("滋賀県", "滋賀", "Shiga",), 35.00, 135.87, "滋賀県", "滋賀県", "pref"),
    (("京都府", "京都", "Kyoto", "Kyōto",), 35.02, 135.76, "京都府", "京都府", "pref"),
    (("大阪府", "大阪", "Osaka", "Ōsaka",), 34.69, 135.50, "大阪府", "大阪府", "pref"),
    (("兵庫県", "兵庫", "Hyogo", "Hyōgo",), 34.69, 135.18, "兵庫県", "兵庫県", "pref"),
    (("奈良県", "奈良", "Nara",), 34.69, 135.83, "奈良県", "奈良県", "pref"),
    (("和歌山県", "和歌山", "Wakayama",), 34.23, 135.17, "和歌山県", "和歌山県", "pref"),
    (("鳥取県", "鳥取", "Tottori",), 35.50, 134.24, "鳥取県", "鳥取県", "pref"),
    (("島根県", "島根", "Shimane",), 35.47, 133.05, "島根県", "島根県", "pref"),
    (("岡山県", "岡山", "Okayama",), 34.66, 133.93, "岡山県", "岡山県", "pref"),
    (("広島県", "広島", "Hiroshima",), 34.40, 132.46, "広島県", "広島県", "pref"),
    (("山口県", "山口", "Yamaguchi",), 34.19, 131.47, "山口県", "山口県", "pref"),
    (("徳島県", "徳島", "Tokushima",), 34.07, 134.56, "徳島県", "徳島県", "pref"),
    (("香川県", "香川", "Kagawa",), 34.34, 134.04, "香川県", "香川県", "pref"),
    (("愛媛県", "愛媛", "Ehime",), 33.84, 132.77, "愛媛県", "愛媛県", "pref"),
    (("高知県", "高知", "Kochi", "Kōchi",), 33.56, 133.53, "高知県", "高知県", "pref"),
    (("福岡県", "福岡", "Fukuoka",), 33.61, 130.42, "福岡県", "福岡県", "pref"),
    (("佐賀県", "佐賀", "Saga",), 33.25, 130.30, "佐賀県", "佐賀県", "pref"),
    (("長崎県", "長崎", "Nagasaki",), 32.74, 129.87, "長崎県", "長崎県", "pref"),
    (("熊本県", "熊本", "Kumamoto",), 32.79, 130.74, "熊本県", "熊本県", "pref"),
    (("大分県", "大分", "Oita", "Ōita",), 33.24, 131.61, "大分県", "大分県", "pref"),
    (("宮崎県", "宮崎", "Miyazaki",), 31.91, 131.42, "宮崎県", "宮崎県", "pref"),
    (("鹿児島県", "鹿児島", "Kagoshima",), 31.56, 130.56, "鹿児島県", "鹿児島県", "pref"),
    (("沖縄県", "沖縄", "Okinawa",), 26.21, 127.68, "沖縄県", "沖縄県", "pref"),
    (("旭川", "Asahikawa",), 43.77, 142.36, "旭川（旭川ラーメン）", "北海道", "landmark"),
    (("札幌", "すすきの", "Sapporo",), 43.06, 141.35, "札幌（札幌ラーメン）", "北海道", "landmark"),
    (("函館", "Hakodate",), 41.77, 140.73, "函館（函館ラーメン）", "北海道", "landmark"),
    (("喜多方", "Kitakata",), 37.65, 139.87, "喜多方（喜多方ラーメン）", "福島県", "landmark"),
    (("佐野", "Sano",), 36.31, 139.58, "佐野（佐野ラーメン）", "栃木県", "landmark"),
    (("横浜", "家系", "Yokohama",), 35.44, 139.64, "横浜（家系ラーメン）", "神奈川県", "landmark"),
    (("八王子", "Hachioji",), 35.66, 139.32, "八王子（八王子ラーメン）", "東京都", "landmark"),
    (("荻窪", "Ogikubo",), 35.70, 139.62, "荻窪", "東京都", "landmark"),
    (("新宿", "Shinjuku",), 35.69, 139.70, "新宿", "東京都", "landmark"),
    (("渋谷", "Shibuya",), 35.66, 139.70, "渋谷", "東京都", "landmark"),
    (("池袋", "Ikebukuro",), 35.73, 139.71, "池袋", "東京都", "landmark"),
    (("秋葉原", "アキバ", "Akihabara",), 35.70, 139.77, "秋葉原", "東京都", "landmark"),
    (("高山", "Takayama",), 36.15, 137.25, "高山（高山ラーメン）", "岐阜県", "landmark"),
    (("名古屋", "台湾ラーメン", "Nagoya",), 35.17, 136.88, "名古屋", "愛知県", "landmark"),
    (("京都市", "一乗寺",), 35.01, 135.77, "京都（京都ラーメン）", "京都府", "landmark"),
    (("大阪市", "梅田", "難波", "なんば",), 34.70, 135.50, "大阪", "大阪府", "landmark"),
    (("和歌山市",), 34.23, 135.17, "和歌山（和歌山ラーメン）", "和歌山県", "landmark"),
    (("尾道", "Onomichi",), 34.41, 133.20, "尾道（尾道ラーメン）", "広島県", "landmark"),
    (("広島市",), 34.39, 132.46, "広島", "広島県", "landmark"),
    (("徳島市",), 34.07, 134.55, "徳島（徳島ラーメン）", "徳島県", "landmark"),
    (("博多", "天神", "長浜", "Hakata",), 33.59, 130.42, "博多（博多ラーメン）", "福岡県", "landmark"),
    (("久留米", "Kurume",), 33.32, 130.51, "久留米（久留米ラーメン）", "福岡県", "landmark"),
    (("熊本市",), 32.80, 130.71, "熊本（熊本ラーメン）", "熊本県", "landmark"),
    (("鹿児島市",), 31.60, 130.56, "鹿児島（鹿児島ラーメン）", "鹿児島県", "landmark"),
    (("那覇", "Naha",), 26.21, 127.69, "那覇（沖縄そば）", "沖縄県", "landmark"),
    (("仙台", "Sendai",), 38.27, 140.87, "仙台", "宮城県", "landmark"),
)
# Kinds from wide to narrow.
KIND_PRIORITY = {"pref": 1, "city": 2, "landmark": 3}
SCHEMA = "ord int, names array<string>, lat double, lon double, label string, pref string, kind string, prio int"


def rows() -> list[tuple]:
    return [(i, list(names), lat, lon, label, pref, kind, KIND_PRIORITY[kind]) for i, (names, lat, lon, label, pref, kind) in enumerate(PLACES)]


def places(spark: SparkSession) -> DataFrame:
    """The gazetteer as a local relation."""
    return spark.createDataFrame(rows(), SCHEMA)


def literal() -> Column:
    """The gazetteer as one constant array of structs: a small foldable expression, which the optimiser turns into a literal."""
    data = [dict(zip(("ord", "names", "lat", "lon", "label", "pref", "kind", "prio"), (o, [{"name": n, "wide": is_wide(n)} for n in names], *rest), strict=True)) for o, names, *rest in rows()]
    return F.from_json(F.lit(json.dumps(data, ensure_ascii=False)), "array<struct<ord:int,names:array<struct<name:string,wide:boolean>>,lat:double,lon:double,label:string,pref:string,kind:string,prio:int>>")


def is_wide(name: str) -> bool:
    """Whether a name has no ASCII character."""
    return not any(c < "\x80" for c in name)


def narrow_names() -> str:
    """A regular expression that finds whether any name with an ASCII character occurs; the look-ahead turns most places down at once."""
    names = sorted({n for _, names, *_ in rows() for n in names if not is_wide(n)})
    return f"(?=[{''.join(sorted({n[0] for n in names}))}])(?:{'|'.join(map(re.escape, names))})"
