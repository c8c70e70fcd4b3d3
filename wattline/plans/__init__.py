"""Plan-shaping helpers: time buckets, cross-bucket stitching, joins with
small sides."""
