"""Declared schemas; nothing is inferred."""

from __future__ import annotations

#: Name and type of each field of a post as sources give it.
RAW_POST = {
    "id": "string", "source": "string", "sourceLabel": "string", "url": "string", "text": "string", "tags": "array<string>", "createdAt": "string", "author": "string", "authorHandle": "string",
    "authorAvatar": "string", "authorLocation": "string", "image": "string", "imageFull": "string", "geo": "struct<lat:double,lon:double>",
}
LOCATED_POST = ("id", "source", "sourceLabel", "url", "text", "tags", "createdAt", "author", "authorHandle", "authorAvatar", "image", "imageFull", "lat", "lon", "locationLabel", "pref", "confidence", "method")
MASTODON_STATUS = (
    "struct<id:string,url:string,content:string,created_at:string,media_attachments:array<struct<type:string,preview_url:string,url:string>>,"
    "tags:array<struct<name:string>>,account:struct<display_name:string,username:string,acct:string,avatar:string>>"
)
X_RESPONSE = (
    "data array<struct<id:string,text:string,created_at:string,author_id:string,attachments:struct<media_keys:array<string>>,entities:struct<hashtags:array<struct<tag:string>>>,"
    "geo:struct<place_id:string,coordinates:struct<coordinates:array<double>>>>>, "
    "includes struct<media:array<struct<media_key:string,type:string,url:string,preview_image_url:string>>,"
    "users:array<struct<id:string,name:string,username:string,profile_image_url:string,location:string>>,places:array<struct<id:string,geo:struct<bbox:array<double>>>>>"
)
GEOJSON = ("features array<struct<geometry:struct<coordinates:array<array<array<array<double>>>>>,properties:struct<nam_ja:string>>>")
