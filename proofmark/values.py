"""Fixed values of the submission data model.

Everything in this file is a value that results must agree with: codes, enumerations, texts and limits.
"""

# Event types, in life-cycle order, and the failure type.
LIFECYCLE = ["RECEIVED", "STARTED", "ARCHIVED", "FINISHED"]
FINISHED = "FINISHED"
FAILURE = "FAILURE"

# Archive status.
ARCHIVE_NOT_SET = "IkkeSatt"
ARCHIVED = "Arkivert"
ARCHIVE_FAILED = "ArkiveringFeilet"
ARCHIVE_STATUSES = [ARCHIVE_NOT_SET, ARCHIVED, ARCHIVE_FAILED]

# Application status.
CREATED = "Opprettet"
COMPLETED = "Utfylt"
SUBMITTED = "Innsendt"
DELETED_BY_USER = "SlettetAvBruker"
DELETED_BY_SCHEDULE = "AutomatiskSlettet"
APPLICATION_STATUSES = [CREATED, COMPLETED, SUBMITTED, DELETED_BY_USER, DELETED_BY_SCHEDULE]

# Attachment upload status.
UPLOAD_STATUSES = [
    "IkkeValgt", "LastetOpp", "Innsendt", "SendSenere", "SendesAvAndre", "SendesIkke",
    "LastetOppIkkeRelevantLenger", "LevertDokumentasjonTidligere", "HarIkkeDokumentasjonen",
    "NavKanHenteDokumentasjon",
]
UPLOADED = "LastetOpp"

# Upload status -> receipt list. "to_follow" holds for required attachments only.
RECEIPT_LISTS = {
    "LastetOpp": "sent",
    "Innsendt": "sent",
    "SendSenere": "to_follow",
    "SendesAvAndre": "by_others",
    "LevertDokumentasjonTidligere": "earlier",
    "SendesIkke": "not_sent",
    "HarIkkeDokumentasjonen": "not_sent",
    "NavKanHenteDokumentasjon": "agency_fetches",
}

APPLICATION_TYPES = ["soknad", "ettersendelse"]
DISPLAY_TYPES = ["fyllUt", "dokumentinnsending", "ettersending", "lospost"]
# Ways to create an application: application type, display type, made by a case worker.
CREATE_KINDS = {
    "application": ("soknad", "fyllUt", False),
    "from_form": ("soknad", "dokumentinnsending", False),
    "followup_by_form": ("ettersendelse", "ettersending", False),
    "followup": ("ettersendelse", "ettersending", False),
    "external_followup": ("ettersendelse", "ettersending", False),
    "task": ("ettersendelse", "ettersending", True),
    "loose_mail": ("soknad", "lospost", False),
}
MIME_TYPES = ["application/pdf", "application/json", "image/png", "image/jpeg", "application/xml"]
FILE_STATUSES = ["ok", "notfound", "deleted"]
NOTIFICATION_TYPES = ["utkast", "oppgave"]
CHANNELS = ["sms", "epost"]
SERVICE_STATUSES = ["OK", "ISSUE", "DOWN"]
TARGET_GROUP_TYPES = [
    "ARBSOKERE", "ENSFORARBS", "ENSFORUTD", "GJENEKARBS", "GJENEKUTD",
    "MOTDAGPEN", "MOTTILTPEN", "NEDSARBEVN", "TIDLFAMPL", "ANNET",
]
ACTIVITY_ENDPOINTS = ["aktivitet", "dagligreise"]

PRESENCE = "PRESENCE"
ABSENCE = "ABSENCE"

# Limits of the checks.
PRESENCE_TIMEOUT_MS = 120_000
ABSENCE_TIMEOUT_MS = 30_000
STATUS_POLLS = 30
STATUS_POLL_MS = 2_000
COUNT_TIMEOUT_MS = 30_000
ARCHIVE_ATTEMPTS = 6
UPLOAD_ATTEMPTS = 3

# Texts of verdicts; {} is filled in by the row.
VERDICT_OK = "ok"
VERDICT_FOR_KEY = "For key {}: "
VERDICT_SAW_VALUE = "Verification failed - Expected not to see value"
VERDICT_SAW_NONE = "Verification failed - Expected to see value but saw none"
VERDICT_FAILED = "Verification failed!\n{}"
VERDICT_NO_EVENT = "Expected '{}' to have a {} Processing Event, but saw none"
VERDICT_CALLS = "For key {}: Expected {} attempts to save to the Archive, but found {}"
VERDICT_ATTACHMENTS = "Forventer {} vedlegg, men søknad har {}."

# Answer when a user already has an active application for the form.
ALREADY_EXISTS = "soknadAlreadyExists"

# The attachment code a user may add, rename and delete.
OTHER_ATTACHMENT = "N6"

# Default end of a period request.
ACTIVITY_DAYS_AHEAD = 60
TARGET_GROUP_END = "2099-12-31"

PERSON_ID_PATTERN = "^[0-9]{11}$"

# Load cases: id, applications, attachments per application, file size in MB, time limit in minutes.
LOAD_CASES = [
    ("TC01", 10, 2, 38, 10),
    ("TC02", 100, 3, 2, 15),
    ("TC03", 1000, 2, 1, 30),
]

# Attachment catalogue in its own order: code, title.
ATTACHMENT_CATALOGUE = [
    ("L8", "Uttalelse fra fagpersonell"),
    ("L9", "Legeerklæring"),
    ("W2", "Vedtak eller avtale om bidrag"),
    ("CC", "Avtale"),
    ("BJ", "Dokumentasjon på ekteskapsinngåelse"),
]

# Defaults of generated submissions.
DEFAULT_SUBMISSION_ID = "behandlingsid"
DEFAULT_THEME = "TSO"
FILE_LIST_THEME = "BIL"
FILE_LIST_TITLE = "Kjøreliste for godkjent bruk av egen bil"
FILE_LIST_FILE_NAME = "innsending.pdf"
DEFAULT_TITLE = "Dummy tittel"
DEFAULT_ATTACHMENT_TITLE = "Dummy vedlegg"
MAIN_FILE_NAME = "hodveddok.pdf"
ATTACHMENT_FILE_NAME = "vedlegg.pdf"
ATTACHMENT_CODE = "O2"
ATTACHMENT_TITLE = "Vedlegg"
RECEIPT_CODE = "L7"
RECEIPT_TITLE = "Kvittering"
PDF = "application/pdf"
JSON = "application/json"
PDF_FILE_TYPE = "PDFA"
JSON_FILE_TYPE = "json"

# Defaults of a follow-up request: language, theme, title, attachment (code, title).
FOLLOWUP_LANGUAGE = "nb"
FOLLOWUP_THEME = "SYK"
FOLLOWUP_TITLE = "Endtoend ettersending"
FOLLOWUP_ATTACHMENT = ("N5", "Endtoend vedlegg")

# Code-list fallback language.
FALLBACK_LANGUAGE = "nb"
