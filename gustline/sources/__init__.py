from gustline.sources.csv_files import get_all_csv_files, header_catalogue, read_csv_directory
from gustline.sources.folders import is_directory
from gustline.sources.jdbc import day_predicates, get_postgresql_options, partitioned_read
from gustline.sources.reader import Reader
from gustline.sources.shared_folder import shared_folder

__all__ = [
    "Reader",
    "day_predicates",
    "get_all_csv_files",
    "get_postgresql_options",
    "header_catalogue",
    "is_directory",
    "partitioned_read",
    "read_csv_directory",
    "shared_folder",
]
