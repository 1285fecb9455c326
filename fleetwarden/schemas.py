"""Explicit schemas of the fleet tables, as DDL strings that ``spark.read.schema`` accepts."""

SERVERS = (
    "id int, game_id string, location string, descr string, dbusage string, ip string, port int, "
    "dbtype string, env string, active int, id_master int, contact_id int"
)
GATEWAYS = "ip string, game_id string, location string"
CONTACTS = "id int, name string, email_to string"
LOCATIONS = "location string, location_iso string, location_name string"
SESSIONS = (
    "dbserver_id int, user_name string, user_host string, session_count int, run_id string, "
    "creation_date timestamp"
)
ACCOUNTS = (
    "dbserver_id int, user_name string, user_host string, part_no bigint, password string, "
    "max_user_connections int, definition string, run_id string"
)
BACKUPS = (
    "dbserver_id int, file string, size bigint, start timestamp, end timestamp, status string, "
    "run_id string"
)
OBJECTS = (
    "dbserver_id int, dbschema string, type string, name string, part_no bigint, definition string, "
    "run_id string, creation_date timestamp, modified_date timestamp"
)
DICTIONARY = (
    "dbschema string, name string, name_regexp string, column_name string, comments string, "
    "line_num int, creation_date timestamp, modified_date timestamp"
)
PARTITIONS = (
    "table_schema string, table_name string, partition_name string, partition_method string, "
    "partition_expression string, partition_description string"
)
USER_ACTIVITY = "uid bigint, last_active_time bigint, level int"
SCORES = "summoner_id bigint, harassment_score int, snitch_score int"
ACCOUNT_INFO = (
    "uid bigint, regip string, acc_country string, gender int, bday date, regdate int, "
    "username string, email string, email_v int"
)
CODES = (
    "id string, promo_batch_id string, created timestamp, modified timestamp, account_id bigint, "
    "active int"
)
COLLECTION_OUTCOME = "dbserver_id int, run_id string, ok boolean"

# Staged interchange files: columns in file order, without the run id added by the load.
STAGED_SESSIONS = "dbserver_id int, user_name string, user_host string, session_count int"
STAGED_ACCOUNTS = (
    "dbserver_id int, user_name string, user_host string, password string, "
    "max_user_connections int, definition string"
)
STAGED_OBJECTS = "dbserver_id int, dbschema string, type string, name string, definition string"
STAGED_BACKUPS = "dbserver_id int, start timestamp, file string, size bigint, end timestamp"
STAGED_GRANTS = "id int, user string, definition string"
STAGED_STATUS = "dbserver_id int, status string, file string"
