"""Job-level plans: import (E1), profile (E2) and the SQL-text form of the import join."""
