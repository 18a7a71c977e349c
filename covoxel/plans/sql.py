"""The documented analytical queries, as SQL over the published tables."""

from __future__ import annotations

TOP_IOU = """
SELECT channels, channel_count, CAST(SUM(total_count) AS BIGINT) AS sum_count, CAST(SUM(total_union) AS BIGINT) AS sum_union,
       CAST(SUM(total_count) AS DOUBLE) / SUM(total_union) AS global_iou
FROM combinations WHERE hierarchy_level = 0 AND dilation = {dilation}
GROUP BY channels, channel_count HAVING SUM(total_union) > 0
ORDER BY global_iou DESC, channels LIMIT {limit}
"""
CHANNEL_TOTALS = """
SELECT channel, CAST(SUM(voxel_count) AS BIGINT) AS total_voxels, SUM(sum_intensity) AS total_intensity
FROM channel_stats WHERE hierarchy_level = 0 AND dilation = {dilation} GROUP BY channel ORDER BY total_voxels DESC, channel
"""
HEATMAP_CHANNEL = """
SELECT tile_x0, tile_y0, voxel_count, mean_intensity FROM channel_stats
WHERE channel = '{channel}' AND hierarchy_level = {level} AND dilation = {dilation}
"""
HEATMAP_PAIR = """
SELECT t.tile_x0, t.tile_y0, t.inter_count, t.union_count, c.iou FROM combinations c JOIN tiles t ON c.id = t.combination_id
WHERE c.channels = '{channels}' AND c.hierarchy_level = {level} AND c.dilation = {dilation}
"""
DILATION_CURVE = """
SELECT dilation, CAST(SUM(total_count) AS BIGINT) AS sum_count, CAST(SUM(total_union) AS BIGINT) AS sum_union,
       CAST(SUM(total_count) AS DOUBLE) / SUM(total_union) AS global_iou
FROM combinations WHERE channels = '{channels}' AND hierarchy_level = 0 GROUP BY dilation ORDER BY dilation
"""
