from stocktake.functions.uri import (  # noqa: F401
    CELL_WHITESPACE,
    S3_URI_PATTERN,
    WEB_URL_PATTERN,
    ancestor_folders,
    base_name,
    clean_cell,
    folder_prefix,
    is_folder_marker,
    is_valid_uri,
    parent_folder,
    quoted,
    render_uri,
    strip_quotes,
    uri_bucket,
    uri_key,
)
