"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from wattline.llm import covertree, decontaminate, html, huffman, interpolate, lines, merkle, mix, secrets, shard, simhash, toxicity, whiten


def catalog() -> dict:
    return {
        "op1_mix_sources": mix.query,
        "op2_toxicity_grammar": toxicity.query,
        "op3_secret_novelty": secrets.query,
        "op4_decontaminate_qgrams": decontaminate.query,
        "op5_sampled_splitter_shards": shard.query,
        "op6_html_line_blocks": html.query,
        "op7_huffman_token_ids": huffman.query,
        "op8_fuzzy_line_dedup": lines.query,
        "op9_cover_tree_top_k": covertree.query,
        "op10_simhash_near_dedup": simhash.query,
        "op11_merkle_manifest": merkle.query,
        "op12_chebyshev_whitening": whiten.query,
        "op13_deleted_interpolation": interpolate.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mix.SQL, "op9_cover_tree_top_k": covertree.SQL, "op11_merkle_manifest": merkle.SQL}
