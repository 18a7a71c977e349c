"""covoxel: spatial co-localization analytics on Spark DataFrames."""
