"""Table schemas of the engine, as DDL strings for ``spark.read.schema`` and ``createDataFrame``."""

RAW_MESSAGES = (
    "key string, value binary, topic string, partition int, offset long, timestamp timestamp, "
    "headers array<struct<key:string,value:binary>>"
)

# One history of all topics. event_type is set for processing events, calls for call counts.
MESSAGES = "topic string, key string, event_type string, calls int, value string, ts timestamp, offset long"

PROCESSING_EVENTS = "key string, event_type string, ts timestamp"
ARCHIVE_ENTITY_JSON = "id string, title string, theme string, timesaved long"
ARCHIVE_ENTITIES = "key string, id string, title string, theme string, time_saved long, ts timestamp"
ARCHIVE_CALLS = "key string, calls int, ts timestamp"
ARCHIVE_FEEDBACK = "key string, message string, ts timestamp"
STATUS_HISTORY = "key string, archive_status string, ts timestamp"

EXPECTATIONS = (
    "expectation_id long, run_id string, topic string, key string, presence string, "
    "expected_type string, expected_count int, registered_at timestamp, timeout_ms long"
)
VERDICTS = (
    "expectation_id long, run_id string, satisfied boolean, decided_at timestamp, "
    "last_value string, message string"
)

APPLICATIONS = (
    "id long, application_id string, linked_id string, user_id string, form_no string, title string, "
    "theme string, language string, status string, app_type string, display_type string, "
    "changed_at timestamp, created_at timestamp, submitted_at timestamp, due_at timestamp, "
    "first_submitted_at timestamp, delete_at timestamp, followup_days long, retention_days int, "
    "can_add_other boolean, archive_status string, system_generated boolean, agency_created boolean, "
    "app_source string, step long"
)
ATTACHMENTS = (
    "id long, application_id string, code string, title string, label string, uuid string, mime string, "
    "is_main boolean, is_variant boolean, is_pdfa boolean, required boolean, upload_status string, "
    "created_at timestamp, submitted_at timestamp, form_component string, comment string, "
    "comment_prompt string"
)
FILES = "id long, attachment_id long, name string, mime string, size long, pages int, created_at timestamp"
STORED_FILES = "id string, content binary, created_at timestamp, file_status string"

SUBMISSIONS = (
    "submission_id string, is_followup boolean, person_id string, theme string, "
    "documents array<struct<form_no:string,is_main:boolean,title:string,"
    "variants:array<struct<id:string,media_type:string,file_name:string,file_type:string>>>>"
)
NOTIFICATIONS = (
    "submission_id string, group_id string, person_id string, is_followup boolean, "
    "system_generated boolean, changed_at timestamp, action string, title string, link string, "
    "active_days int, channels array<struct<channel:string,text:string,title:string>>"
)
FORM_CATALOGUE = "form_no string, theme string, title string"
ACTIVITIES = (
    "activity_id string, person_id string, type string, name string, status string, from_date date, "
    "to_date date, days_per_week long, percent long, eligible boolean, educational boolean, "
    "organiser string, case struct<case_id:string,decisions:array<struct<decision_id:string,"
    "from_date:date,to_date:date,daily_travel:boolean,payment_plan:array<struct<plan_id:string,"
    "amount:long,from_date:date,to_date:date,journal_id:string>>>>>, "
    "target_group struct<group_type:string,name:string>"
)
TARGET_GROUPS = "person_id string, group_type string, name string, from_date date, to_date date"
LOAD_CASES = "case_id string, applications int, attachments int, file_size_mb int, timeout_min int"
RUN_LOG = (
    "run_id string, case_id string, started_at timestamp, finished_at timestamp, ok boolean, error string"
)
UPLOAD_LOG = (
    "application_id string, file_no int, started_ms long, finished_ms long, attempt int, ok boolean, "
    "error string"
)
HEALTH = "run_id string, service string, status string"
GAUGES = "run_id string, name string, labels map<string,string>, value double, at timestamp"
