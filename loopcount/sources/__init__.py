"""Readers. Every reader returns a DataFrame in one of the canonical input shapes:

- raw volumes: ``site, qt_interval, detector, raw`` (``raw`` = ARRAY<STRING> of the 96 count texts)
- points: ``site, wkt`` plus order columns
- lines: ``hfidl, hfidr, wkt`` plus order columns
- layouts: ``site, ds_location, detector, dt_general, nb_lane, lane_mvt, loc_mvt, hf_id`` plus order columns
"""
