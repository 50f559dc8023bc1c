"""Schemas of files the library reads and writes."""

CHAT_CSV = (
    "seq BIGINT, msgid STRING, action STRING, sender STRING, receiver STRING, roomid STRING, msgtime STRING, "
    "msgtype STRING, sdkfileid STRING, md5sum STRING, raw_json STRING"
)
CHAT_EXT_CSV = CHAT_CSV.replace(", raw_json", ", fileext STRING, raw_json")
EXTERNAL_ID_CSV = "external_userid STRING"
ID_MAPPING_CSV = "external_userid STRING, unionid STRING"
MANIFEST_JSON = "msgtype STRING, sdkfileid STRING, md5sum STRING, fileext STRING"
ENVELOPE_JSON = (
    "chatdata ARRAY<STRUCT<seq: STRING, msgid: STRING, encrypt_random_key: STRING, encrypt_chat_msg: STRING, message: STRING>>"
)
