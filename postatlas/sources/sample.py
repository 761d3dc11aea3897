"""The built-in sample posts, relative to a given time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hashtags
from ..functions.times import iso
from ..schemas import RAW_POST

# Fixed values: (text, place, author, geotag, image).
SAMPLES = (
    ("深夜の一杯🍜 濃厚味噌ラーメン、コーンバター最高。#札幌 #ラーメン #味噌ラーメン", "札幌", "susukino_gohan", (43.055, 141.353), 1),
    ("旭川ラーメン食べてきた。ダブルスープの醤油が沁みる〜 #旭川 #ラーメン", "旭川", "asahikawa_noodle", None, 2),
    ("喜多方ラーメンの朝ラー最高。平打ち縮れ麺うまい #喜多方 #らーめん", "喜多方", "kitakata_asa", None, 4),
    ("佐野ラーメン、青竹打ちのちぢれ麺！ #佐野 #栃木 #ラーメン", "佐野", "tochigi_men", None, 7),
    ("新宿で味玉つけ麺。並んだ甲斐あった #新宿 #つけ麺", "新宿", "tokyo_ramen_bot", None, 6),
    ("横浜家系、ライス必須です🍚 #横浜 #家系ラーメン", "横浜", "iekei_lover", (35.444, 139.638), 5),
    ("八王子ラーメン、刻み玉ねぎが効いてる #八王子 #東京", "八王子", "hachioji_gurume", None, 3),
    ("名古屋の台湾ラーメン、辛旨！ #名古屋 #ラーメン", "名古屋", "nagoya_meshi", None, 10),
    ("高山ラーメン、あっさり醤油が優しい #高山 #岐阜", "高山", "hida_tabi", None, 2),
    ("京都 一乗寺の背脂醤油！こってり #京都 #ラーメン", "一乗寺", "kyoto_men", None, 5),
    ("大阪 難波でこってり豚骨醤油🍜 #なんば #大阪 #ラーメン", "なんば", "osaka_noodle", (34.665, 135.501), 3),
    ("和歌山ラーメン、早すしと一緒に #和歌山 #ラーメン", "和歌山市", "wakayama_gohan", None, 8),
    ("尾道ラーメン、背脂と小魚だしが効いてる #尾道 #広島", "尾道", "onomichi_tabi", None, 9),
    ("徳島ラーメン、生卵トッピングでご飯が進む #徳島 #ラーメン", "徳島市", "tokushima_men", None, 10),
    ("博多長浜、替え玉2回いきました #博多 #豚骨ラーメン", "博多", "hakata_barikata", (33.59, 130.401), 3),
    ("久留米ラーメン、元祖豚骨のスープ濃厚 #久留米 #福岡", "久留米", "kurume_tonkotsu", None, 3),
    ("熊本ラーメン、マー油と焦がしにんにく🧄 #熊本 #ラーメン", "熊本市", "kumamoto_men", None, 10),
    ("那覇で沖縄そば、三枚肉たっぷり #那覇 #沖縄そば", "那覇", "naha_soba", (26.212, 127.681), 7),
    ("仙台で辛味噌ラーメンあたたまる〜 #仙台 #宮城 #ラーメン", "仙台", "sendai_gurume", None, 1),
    ("池袋で二郎系、野菜マシマシ💪 #池袋 #ラーメン", "池袋", "jiro_daisuki", None, 6),
)


def sample_posts(spark: SparkSession, now: Column) -> DataFrame:
    """RawPost rows with their ordinal; row i is (7 i + 3) mod 56 minutes old."""
    local = spark.createDataFrame([(i, *s[:3], s[3] and {"lat": s[3][0], "lon": s[3][1]}, s[4]) for i, s in enumerate(SAMPLES)], "i int, text string, place string, author string, geo struct<lat:double,lon:double>, img int")
    image = F.concat(F.lit("/images/ramen-"), F.lpad(F.col("img").cast("string"), 2, "0"), F.lit(".svg"))
    minutes = F.pmod(F.col("i") * 7 + 3, F.lit(56))
    return local.select(
        F.col("i").cast("long").alias("ord"),
        F.concat(F.lit("sample:"), "i").alias("id"),
        F.lit("sample").alias("source"),
        F.lit("サンプル (デモ)").alias("sourceLabel"),
        F.lit(None).cast("string").alias("url"),
        "text",
        hashtags(F.col("text")).alias("tags"),
        iso(now - F.make_dt_interval(mins=minutes)).alias("createdAt"),
        "author",
        F.concat(F.lit("@"), "author").alias("authorHandle"),
        F.lit(None).cast("string").alias("authorAvatar"),
        F.col("place").alias("authorLocation"),
        image.alias("image"),
        image.alias("imageFull"),
        "geo",
    ).select("ord", *RAW_POST)
