"""Operators for building training corpora: quality scoring, token files,
near-duplicate search, nearest neighbours, web archives, license scans, line
dedup, segmentation, packing, ranked search, fingerprints and manifests.  Nothing outside this package imports it.
"""
