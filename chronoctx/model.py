"""Names and schemas of the data model."""

# Protocol header names (matched case-insensitively).
HEADER_SERVICE = "fiware-service"
HEADER_SERVICE_PATH = "fiware-servicepath"
HEADER_CORRELATOR = "fiware-correlator"

# Column names of the stored layouts.
RECV_TIME_TS = "recvTimeTs"
RECV_TIME = "recvTime"
SERVICE_PATH = "fiwareServicePath"
ENTITY_ID = "entityId"
ENTITY_TYPE = "entityType"
ATTR_NAME = "attrName"
ATTR_TYPE = "attrType"
ATTR_VALUE = "attrValue"
ATTR_MD = "attrMd"
ATTR_MD_FILE = "attrMdFile"

ROW_COLUMNS = [
    RECV_TIME_TS, RECV_TIME, SERVICE_PATH, ENTITY_ID, ENTITY_TYPE,
    ATTR_NAME, ATTR_TYPE, ATTR_VALUE, ATTR_MD,
]

# Columns of the trajectory store, in order.
TRAJECTORY_COLUMNS = [
    "cartodb_id", RECV_TIME_TS, SERVICE_PATH, ENTITY_ID, ENTITY_TYPE,
    "the_geom", "the_geom_webmercator",
    "stageDistance", "stageTime", "stageSpeed",
    "sumDistance", "sumTime", "sumSpeed",
    "sum2Distance", "sum2Time", "sum2Speed",
    "maxDistance", "minDistance", "maxTime", "minTime", "maxSpeed", "minSpeed",
    "numSamples",
]

# A notification as received: one row per HTTP notification.
RAW_SCHEMA = "headers map<string,string>, body string, ingest_ts timestamp"

MD_TYPE = "array<struct<name:string,type:string,value:string>>"
