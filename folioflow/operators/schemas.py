"""Relations of the corpus, as Spark DDL."""

WORDS = "file_id string, page_num int, word_seq int, text string, x0 double, top double, size double, fontname string, color_kind string, color array<double>, page_w double, page_h double"
PAGES = "file_id string, page_num int, text string, status string, column_layout string, error_detail string, cid_word_pct double"
HEADER = "file_id string, gaceta_number string, publication_date string, publication_date_confidence string, session_date string, session_date_confidence string, chamber string, committee string, committee_confidence string, document_type string, date_source string, extraction_status string"
TURNS = "file_id string, speech_id string, position_in_session int, attribution_raw string, speech_text string, word_count int, is_continuation boolean, record_type string, rule_version string"
SPEECHES = "speech_id string, session_id string, file_id string, gaceta_number string, publication_date string, session_date string, chamber string, committee string, attribution_raw string, speech_text string, word_count int, position_in_session int, is_continuation boolean, record_type string, rule_version string, qa_flag boolean, date_source string"
SESSIONS = "session_id string, file_id string, gaceta_number string, publication_date string, session_date string, year_extracted int, chamber string, committee string, document_type string, transcript_start_page int, n_pages_total int, n_pages_scanned int, n_speeches int, n_flagged int, processing_status string, rule_version string, processing_timestamp timestamp, header_confidence string, extraction_status string"
LOG = "file_id string, status string, rule_version string, n_speeches int, n_flagged int, error_detail string, processing_timestamp timestamp"
FLAGS = "file_id string, speech_id string, page_num string, year_extracted int, failure_type string, severity string, original_excerpt string, diagnosis string, rule_version string, resolved string"
SCANNED = "file_id string, page_num int, cid_word_pct double"
MANIFEST = "file_id string, status string, session_id int, rule_version string, processing_timestamp timestamp, n_speeches int, n_flagged int, session_date string, year_extracted int, document_type string"


def columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]
