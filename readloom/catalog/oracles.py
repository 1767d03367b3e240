"""DuckDB SQL for the registered queries.

``VIEWS`` holds named building blocks in dependency order. Each oracle is one
statement; ``oracle`` puts the blocks it mentions, and theirs, in a WITH clause.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    # --- fixtures -------------------------------------------------------------
    "letters": r"""SELECT doc_id, source,
        regexp_replace(regexp_replace(lower(text), '[^\p{L}]', '', 'g'), '[^a-z]', 'x', 'g') AS t FROM documents""",
    "runs": """SELECT doc_id, source, i, substr(t, 1 + 51 * i, 51) AS k FROM (
        SELECT doc_id, source, t, unnest(range(0, greatest((length(t) + 50) // 51, 1))) AS i FROM letters)""",
    "reads": """SELECT concat('R', doc_id, '_', i) AS read_id, source AS sample,
        CASE WHEN i % 7 = 3 THEN substr(concat(substr(b, 1, greatest(n - 15, 0)), repeat('G', 15)), 1, n)
             WHEN i % 11 = 5 THEN substr(concat(substr(b, 1, 10 + doc_id % 20),
                                  'AGATCGGAAGAGCACACGTCTGAACTCCAGTCA', b), 1, n)
             WHEN i % 13 = 6 THEN substr(concat('NNNNNN', substr(b, 7)), 1, n)
             ELSE b END AS seq, q AS qual
        FROM (SELECT doc_id, source, i, length(k) AS n,
                translate(k, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTNACGTACGTACGTA') AS b,
                translate(k, 'abcdefghijklmnopqrstuvwxyz', 'IIFFIIFF<<IIFF55II##FFII<<') AS q
              FROM runs)""",
    "pieces": """SELECT doc_id, p, substr(t, 1 + 512 * p, 512) AS piece FROM (
        SELECT doc_id, t, unnest(range(0, (length(t) + 511) // 512)) AS p FROM letters)""",
    "contigs": """SELECT CASE WHEN doc_id % 5 = 4 THEN 'chrM' ELSE concat('chr', doc_id % 5 + 1) END AS chrom,
        CAST(c AS INTEGER) AS chunk_no, CAST(c * 512 AS BIGINT) AS "offset",
        rpad(translate(piece, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTNACGTACGTACGTA'), 512, 'N') AS seq
        FROM (SELECT *, p * ((SELECT max(doc_id) FROM documents) // 5 + 1) + doc_id // 5 AS c FROM pieces)""",
    "exons": """SELECT concat('G', lpad(CAST(g AS VARCHAR), 6, '0')) AS gene_id,
        CASE WHEN g % 5 = 4 THEN 'chrM' ELSE concat('chr', g % 5 + 1) END AS chrom,
        CAST(1 + (g // 5) * 400 + x * 120 + p_size AS BIGINT) AS start_pos,
        CAST(1 + (g // 5) * 400 + x * 120 + p_size + 20 + p_size * 2 AS BIGINT) AS end_pos,
        CASE WHEN g % 2 = 0 THEN '+' ELSE '-' END AS strand
        FROM (SELECT p_partkey % 4 AS x, p_size, p_partkey // 4 AS g FROM part)""",
    "features": """SELECT gene_id, chrom, start_pos, end_pos, strand, 'exon' AS feature FROM exons
        UNION ALL SELECT gene_id, chrom, min(start_pos), max(end_pos), strand, 'gene' FROM exons
        GROUP BY gene_id, chrom, strand""",
    "dictionary": "SELECT chrom, max(end_pos) + 1000 AS length FROM exons GROUP BY 1",
    "alignments": """SELECT l_returnflag AS sample,
        concat(l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) AS read_id,
        CAST(CASE WHEN l_suppkey % 20 = 0 THEN 4 ELSE
            (CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END)
          + (CASE WHEN l_partkey % 10 = 0 AND l_linenumber > 3 THEN 256 ELSE 0 END)
          + (CASE WHEN l_suppkey % 20 = 1 THEN 1024 ELSE 0 END) END AS INTEGER) AS flag,
        CASE WHEN g % 5 = 4 THEN 'chrM' ELSE concat('chr', g % 5 + 1) END AS chrom,
        CAST(1 + (g // 5) * 400 + CAST(floor(l_extendedprice) AS BIGINT) % 400 AS BIGINT) AS pos,
        CASE l_linenumber WHEN 2 THEN '30M150N21M' WHEN 3 THEN '5S46M' WHEN 4 THEN '20M2I29M'
             WHEN 5 THEN '25M3D26M' WHEN 6 THEN '10M15N41M' ELSE '51M' END AS cigar,
        CAST(CASE WHEN l_partkey % 10 = 0 THEN (CASE WHEN l_suppkey % 2 = 0 THEN 3 ELSE 0 END)
             WHEN l_quantity < 4 THEN 5 ELSE 255 END AS INTEGER) AS mapq,
        CAST(CASE WHEN l_suppkey % 20 = 0 THEN NULL
             WHEN l_partkey % 10 = 0 THEN (CASE WHEN l_suppkey % 2 = 0 THEN 2 ELSE 24 END)
             ELSE 1 END AS INTEGER) AS nh,
        CAST(CASE WHEN l_suppkey % 20 <> 0 THEN round(l_tax * 100) END AS INTEGER) AS nm
        FROM (SELECT *, l_partkey // 4 AS g FROM lineitem)""",
    "alignments_md": """SELECT * EXCLUDE (k), CASE WHEN CAST(split_part(read_id, '_', 1) AS BIGINT) % 7 <> 0 AND nm IS NOT NULL THEN
        CASE WHEN cigar = '25M3D26M' THEN concat(repeat('3A', k), 25 - 4 * k, '^ACG26')
          ELSE concat(repeat('3A', k), CASE cigar WHEN '5S46M' THEN 46 WHEN '20M2I29M' THEN 49 ELSE 51 END - 4 * k) END
          END AS md
        FROM (SELECT *, CASE WHEN nm IS NOT NULL THEN
          greatest(nm - CASE cigar WHEN '20M2I29M' THEN 2 WHEN '25M3D26M' THEN 3 ELSE 0 END, 0) END AS k FROM alignments)""",
    "input_reads": """SELECT DISTINCT sample, read_id FROM alignments
        UNION ALL SELECT ['A', 'N', 'R'][o_orderkey % 3 + 1], concat('left_out_', o_orderkey) FROM orders""",
    "counts": """SELECT concat('G', lpad(CAST(l_partkey AS VARCHAR), 6, '0')) AS gene_id, l_returnflag AS sample,
        CAST(sum(l_quantity) AS BIGINT) AS "count", CAST(200 + max(p_size) * 40 AS INTEGER) AS length
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    # File name endings, first choice first.
    "suffixes": """SELECT * FROM (VALUES (0, '_1.fastq'), (1, '_1.fastq.gz'), (2, '.fastq'), (3, '.fastq.gz'),
        (4, '.sra.fastq'), (5, '.sra.fastq.gz')) AS v(priority, suffix)""",
    "listing": """SELECT source AS sample,
        concat(source, CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN '.txt' ELSE suffix END) AS path,
        CASE WHEN doc_id % 17 = 0 THEN 0 ELSE n_chars END AS length
        FROM documents JOIN suffixes ON priority = (doc_id // 20) % 6""",
    "manifest": """SELECT concat('D', doc_id) AS sample, concat(source, '/D', doc_id, '.fastq') AS path,
        n_chars AS length FROM documents""",
    "finished": """SELECT concat('D', doc_id) AS sample, stage,
        CASE WHEN doc_id % 17 = 0 THEN 0 ELSE n_chars END AS length
        FROM documents, (VALUES (0, 'raw'), (1, 'trimmed'), (2, 'aligned')) AS v(i, stage)
        WHERE doc_id % (i + 3) <> 0""",
    # --- reads ------------------------------------------------------------------
    "scores": "SELECT *, [ascii(c) - 33 for c in string_split(qual, '')] AS s, length(qual) AS n FROM reads",
    "cut": """SELECT read_id, sample, substr(seq, 1, keep) AS seq, substr(qual, 1, keep) AS qual,
        seq AS raw_seq, qual AS raw_qual FROM (
          SELECT *, coalesce(list_min([i for i in range(1, n - 2)
              if s[i] + s[i + 1] + s[i + 2] + s[i + 3] < 80]) - 1, n) AS keep FROM scores)""",
    "no_poly_g": """SELECT read_id, sample, raw_seq, raw_qual, regexp_replace(seq, 'G{10,}$', '') AS seq,
        substr(qual, 1, length(regexp_replace(seq, 'G{10,}$', ''))) AS qual FROM cut""",
    "no_adapter": """SELECT read_id, sample, raw_seq, raw_qual, substr(seq, 1, keep) AS seq,
        substr(qual, 1, keep) AS qual FROM (
          SELECT *, CASE WHEN instr(seq, 'AGATCGGAAGAG') > 0 THEN instr(seq, 'AGATCGGAAGAG') - 1
                         ELSE length(seq) END AS keep FROM no_poly_g)""",
    "chain": """SELECT *, CASE
          WHEN length(seq) - length(replace(seq, 'N', '')) > 5 THEN 'too_many_N'
          WHEN (length(qual) - length(regexp_replace(qual, '[!-4]', '', 'g'))) * 100 > 30 * length(qual)
            THEN 'low_quality'
          WHEN length(seq) < 36 THEN 'too_short' ELSE 'passed' END AS reason FROM no_adapter""",
    "staged": """SELECT sample, 'raw' AS stage, raw_seq AS seq, raw_qual AS qual FROM chain
        UNION ALL SELECT sample, 'trimmed', seq, qual FROM chain WHERE reason = 'passed'""",
    "totals": """SELECT sample, stage, count(*) AS n_reads, CAST(sum(length(seq)) AS BIGINT) AS bases,
        CAST(sum(length(qual) - length(regexp_replace(qual, '[5-~]', '', 'g'))) AS BIGINT) AS q20_bases,
        CAST(sum(length(qual) - length(regexp_replace(qual, '[?-~]', '', 'g'))) AS BIGINT) AS q30_bases,
        CAST(sum(length(seq) - length(regexp_replace(seq, '[GC]', '', 'g'))) AS BIGINT) AS gc_bases
        FROM staged GROUP BY 1, 2""",
    "basic": """SELECT sample, stage, count(*) AS total_sequences, CAST(sum(length(seq)) AS BIGINT) AS total_bases,
        CAST(min(length(seq)) AS INTEGER) AS min_len, CAST(max(length(seq)) AS INTEGER) AS max_len,
        CAST(100 * sum(length(seq) - length(regexp_replace(seq, '[GC]', '', 'g')))
          // sum(length(seq) - length(regexp_replace(seq, '[ACGT]', '', 'g'))) AS BIGINT) AS pct_gc
        FROM staged GROUP BY 1, 2""",
    "qual_at": """SELECT sample, stage, pos, ascii(c) - 33 AS q, count(*) AS n FROM (
        SELECT sample, stage, unnest(string_split(qual, '')) AS c, unnest(range(1, length(qual) + 1)) AS pos
        FROM staged) GROUP BY 1, 2, 3, 4""",
    "base_at": """SELECT sample, stage, pos, c, count(*) AS n FROM (
        SELECT sample, stage, unnest(string_split(seq, '')) AS c, unnest(range(1, length(seq) + 1)) AS pos
        FROM staged) GROUP BY 1, 2, 3, 4""",
    "qual_cum": """SELECT *, sum(n) OVER (PARTITION BY sample, stage, pos ORDER BY q) AS cum,
        sum(n) OVER (PARTITION BY sample, stage, pos) AS total FROM qual_at""",
    "base_quality": """SELECT sample, stage, CAST(pos AS INTEGER) AS pos,
        CAST(sum(q * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS mean,
        CAST(min(q) FILTER (cum * 100 >= total * 50) AS INTEGER) AS median,
        CAST(min(q) FILTER (cum * 100 >= total * 25) AS INTEGER) AS q1,
        CAST(min(q) FILTER (cum * 100 >= total * 75) AS INTEGER) AS q3,
        CAST(min(q) FILTER (cum * 100 >= total * 10) AS INTEGER) AS p10,
        CAST(min(q) FILTER (cum * 100 >= total * 90) AS INTEGER) AS p90
        FROM qual_cum GROUP BY 1, 2, 3""",
    "read_quality": """SELECT sample, stage, CAST(list_sum([ascii(c) - 33 for c in string_split(qual, '')]) // length(qual) AS BIGINT) AS q,
        count(*) AS n FROM staged WHERE length(qual) > 0 GROUP BY 1, 2, 3""",
    "base_content": """SELECT sample, stage, CAST(pos AS INTEGER) AS pos,
        100.0::DOUBLE * coalesce(sum(n) FILTER (c = 'G'), 0)::DOUBLE / (sum(n) FILTER (c <> 'N'))::DOUBLE AS pct_g,
        100.0::DOUBLE * coalesce(sum(n) FILTER (c = 'A'), 0)::DOUBLE / (sum(n) FILTER (c <> 'N'))::DOUBLE AS pct_a,
        100.0::DOUBLE * coalesce(sum(n) FILTER (c = 'T'), 0)::DOUBLE / (sum(n) FILTER (c <> 'N'))::DOUBLE AS pct_t,
        100.0::DOUBLE * coalesce(sum(n) FILTER (c = 'C'), 0)::DOUBLE / (sum(n) FILTER (c <> 'N'))::DOUBLE AS pct_c
        FROM base_at GROUP BY 1, 2, 3 HAVING sum(n) FILTER (c <> 'N') > 0""",
    "base_n": """SELECT sample, stage, CAST(pos AS INTEGER) AS pos,
        100.0::DOUBLE * coalesce(sum(n) FILTER (c = 'N'), 0)::DOUBLE / sum(n)::DOUBLE AS pct_n
        FROM base_at GROUP BY 1, 2, 3""",
    "gc_reads": """SELECT sample, stage, length(seq) AS n, length(seq) - length(regexp_replace(seq, '[GC]', '', 'g')) AS g
        FROM staged WHERE length(seq) > 0""",
    "gc_hist": """SELECT s.sample, s.stage, CAST(b.gc AS INTEGER) AS gc, coalesce(h.n, 0) AS n_reads
        FROM (SELECT DISTINCT sample, stage FROM gc_reads) s
        CROSS JOIN (SELECT unnest(range(0, 101)) AS gc) b
        LEFT JOIN (SELECT sample, stage, (200 * g + n) // (2 * n) AS gc, count(*) AS n FROM gc_reads GROUP BY 1, 2, 3) h
        ON h.sample = s.sample AND h.stage = s.stage AND h.gc = b.gc""",
    "gc_top": """SELECT sample, stage, sum(n_reads)::DOUBLE AS total, max(n_reads) AS highest,
        arg_max(gc, n_reads * 1000 - gc) AS top FROM gc_hist GROUP BY 1, 2""",
    "gc_peak": """SELECT sample, stage, any_value(total) AS total, any_value(highest) AS highest,
        coalesce((min(gc) FILTER (gc > top AND n_reads <= 0.9::DOUBLE * highest) + max(gc) FILTER (gc < top AND n_reads <= 0.9::DOUBLE * highest)) / 2.0,
          any_value(top))::DOUBLE AS peak FROM gc_hist JOIN gc_top USING (sample, stage) GROUP BY 1, 2""",
    "gc_fit": """SELECT sample, stage, 100.0::DOUBLE * sum(abs(n - total * exp(-away / (2.0::DOUBLE * var)) / sqrt(2.0::DOUBLE * pi() * var))) / max(total) AS gc_deviation FROM (
        SELECT *, greatest(sum(n * away) OVER (PARTITION BY sample, stage) / greatest(total - 1, 1.0::DOUBLE), 0.25::DOUBLE) AS var FROM (
          SELECT sample, stage, total, n_reads::DOUBLE AS n, (gc - peak) * (gc - peak) AS away
          FROM gc_hist JOIN gc_peak USING (sample, stage))) GROUP BY 1, 2""",
    "copies": "SELECT sample, stage, substr(seq, 1, 50) AS seq_key, count(*) AS copies FROM staged GROUP BY 1, 2, 3",
    "dup_share": """SELECT sample, stage, 100.0::DOUBLE * count(*)::DOUBLE / sum(copies)::DOUBLE AS dedup_pct,
        100.0::DOUBLE * max(copies)::DOUBLE / sum(copies)::DOUBLE AS max_sequence_pct FROM copies GROUP BY 1, 2""",
    # Adapter names and 12-mers.
    "adapters": """SELECT * FROM (VALUES (0, 'illumina_universal_adapter', 'Illumina Universal Adapter', 'AGATCGGAAGAG'),
        (1, 'illumina_small_rna_3_adapter', 'Illumina Small RNA 3'' Adapter', 'TGGAATTCTCGG'),
        (2, 'illumina_small_rna_5_adapter', 'Illumina Small RNA 5'' Adapter', 'GATCGTCGGACT'),
        (3, 'nextera_transposase_sequence', 'Nextera Transposase Sequence', 'CTGTCTCTTATA'),
        (4, 'polya', 'PolyA', 'AAAAAAAAAAAA'), (5, 'polyg', 'PolyG', 'GGGGGGGGGGGG'))
        AS v(i, col, name, probe)""",
    "adapter_cells": """SELECT s.sample, s.stage, p.pos, a.col,
        100.0::DOUBLE * count(h.at)::DOUBLE / max(s.total)::DOUBLE AS pct
        FROM (SELECT sample, stage, count(*) AS total, max(length(seq)) - 11 AS last FROM staged GROUP BY 1, 2) s
        JOIN (SELECT unnest(range(1, 60)) AS pos) p ON p.pos <= s.last
        CROSS JOIN adapters a
        LEFT JOIN (SELECT sample, stage, col, instr(seq, probe) AS at FROM staged, adapters WHERE contains(seq, probe)) h
        ON h.sample = s.sample AND h.stage = s.stage AND h.col = a.col AND h.at <= p.pos
        GROUP BY 1, 2, 3, 4""",
    "adapter_share": "SELECT sample, stage, max(pct) AS max_adapter_pct FROM adapter_cells GROUP BY 1, 2",
    "measures": """SELECT sample, stage, 'total_sequences' AS measure, total_sequences::DOUBLE AS value FROM basic
        UNION ALL SELECT sample, stage, 'min_length', min_len::DOUBLE FROM basic
        UNION ALL SELECT sample, stage, 'length_spread', (max_len - min_len)::DOUBLE FROM basic
        UNION ALL SELECT sample, stage, 'min_lower_quartile', min(q1)::DOUBLE FROM base_quality GROUP BY 1, 2
        UNION ALL SELECT sample, stage, 'min_median', min(median)::DOUBLE FROM base_quality GROUP BY 1, 2
        UNION ALL SELECT sample, stage, 'mode_quality', arg_max(q, n * 1000 - q)::DOUBLE FROM read_quality GROUP BY 1, 2
        UNION ALL SELECT sample, stage, 'max_base_difference', max(greatest(abs(pct_a - pct_t), abs(pct_g - pct_c)))
          FROM base_content GROUP BY 1, 2
        UNION ALL SELECT sample, stage, 'max_pct_n', max(pct_n) FROM base_n GROUP BY 1, 2
        UNION ALL SELECT sample, stage, 'gc_deviation', gc_deviation FROM gc_fit
        UNION ALL SELECT sample, stage, 'dedup_pct', dedup_pct FROM dup_share
        UNION ALL SELECT sample, stage, 'max_sequence_pct', max_sequence_pct FROM dup_share
        UNION ALL SELECT sample, stage, 'max_adapter_pct', max_adapter_pct FROM adapter_share""",
    # Module titles and their limits.
    "thresholds": """SELECT * FROM (VALUES
        ('Basic Statistics', 'total_sequences', -1, NULL, NULL),
        ('Per base sequence quality', 'min_lower_quartile', -1, 10.0, 5.0),
        ('Per base sequence quality', 'min_median', -1, 25.0, 20.0),
        ('Per sequence quality scores', 'mode_quality', -1, 27.0, 20.0),
        ('Per base sequence content', 'max_base_difference', 1, 10.0, 20.0),
        ('Per sequence GC content', 'gc_deviation', 1, 15.0, 30.0),
        ('Per base N content', 'max_pct_n', 1, 5.0, 20.0),
        ('Sequence Length Distribution', 'length_spread', 1, 0.0, NULL),
        ('Sequence Length Distribution', 'min_length', -1, NULL, 1.0),
        ('Sequence Duplication Levels', 'dedup_pct', -1, 70.0, 50.0),
        ('Overrepresented sequences', 'max_sequence_pct', 1, 0.1, 1.0),
        ('Adapter Content', 'max_adapter_pct', 1, 5.0, 10.0)) AS v(module, measure, side, warn, fail)""",
    "qc_status": """SELECT sample, stage, module, CASE max(level) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS status
        FROM (SELECT *, CASE WHEN side * value > side * fail::DOUBLE THEN 2
                             WHEN side * value > side * warn::DOUBLE THEN 1 ELSE 0 END AS level
              FROM measures JOIN thresholds USING (measure)) GROUP BY 1, 2, 3""",
    "stage_metrics": """SELECT sample, stage, 'reads' AS metric, n_reads::DOUBLE AS value FROM totals
        UNION ALL SELECT sample, stage, 'bases', bases::DOUBLE FROM totals
        UNION ALL SELECT sample, stage, 'mean_length', bases::DOUBLE / n_reads::DOUBLE FROM totals
        UNION ALL SELECT sample, stage, 'q20_pct', 100.0::DOUBLE * q20_bases::DOUBLE / bases::DOUBLE FROM totals
        UNION ALL SELECT sample, stage, 'q30_pct', 100.0::DOUBLE * q30_bases::DOUBLE / bases::DOUBLE FROM totals
        UNION ALL SELECT sample, stage, 'gc_pct', pct_gc::DOUBLE FROM basic
        UNION ALL SELECT sample, stage, 'dedup_pct', dedup_pct FROM dup_share
        UNION ALL SELECT sample, stage, 'max_adapter_pct', max_adapter_pct FROM adapter_share""",
    "compared": """SELECT sample, metric, max(value) FILTER (stage = 'raw') AS before,
        max(value) FILTER (stage = 'trimmed') AS after FROM stage_metrics GROUP BY 1, 2""",
    # --- alignments ---------------------------------------------------------------
    "cigar_runs": """SELECT cigar, unnest([CAST(x AS BIGINT) for x in regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 1)]) AS len,
        unnest(regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 2)) AS op,
        unnest(range(1, len(regexp_extract_all(cigar, '[MIDNSHP=X]')) + 1)) AS k
        FROM (SELECT DISTINCT cigar FROM alignments)""",
    "cigar_blocks": """SELECT cigar, blk, CAST(min(off) AS BIGINT) AS o1, CAST(max(off + len) - 1 AS BIGINT) AS o2,
        CAST(sum(CASE WHEN op IN ('M', '=', 'X') THEN len ELSE 0 END) AS BIGINT) AS matched FROM (
          SELECT *, coalesce(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END)
              OVER (PARTITION BY cigar ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
            sum(CASE WHEN op = 'N' THEN 1 ELSE 0 END) OVER (PARTITION BY cigar ORDER BY k) AS blk
          FROM cigar_runs) WHERE op IN ('M', 'D', '=', 'X') GROUP BY 1, 2""",
    "md_sites": """SELECT md, tok[i] AS base, coalesce(list_sum([CASE WHEN regexp_matches(x, '^[0-9]') THEN CAST(x AS BIGINT)
          WHEN x[1] = '^' THEN length(x) - 1 ELSE 1 END for x in tok[1 : i - 1]]), 0) AS off
        FROM (SELECT md, tok, unnest(range(1, len(tok) + 1)) AS i FROM (
          SELECT md, regexp_extract_all(md, '[0-9]+|\\^[A-Z]+|[A-Z]') AS tok
          FROM (SELECT DISTINCT md FROM alignments_md WHERE md IS NOT NULL)))
        WHERE regexp_full_match(tok[i], '[A-Z]')""",
    "block_offsets": """SELECT cigar, o1, o2, coalesce(sum(o2 - o1 + 1) OVER (PARTITION BY cigar ORDER BY blk
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cigar_blocks""",
    "cigar_introns": """SELECT cigar, o2 + 1 AS i1, next_o1 - 1 AS i2, least(matched, next_matched) AS overhang FROM (
        SELECT *, lead(o1) OVER w AS next_o1, lead(matched) OVER w AS next_matched FROM cigar_blocks
        WINDOW w AS (PARTITION BY cigar ORDER BY blk)) WHERE next_o1 IS NOT NULL""",
    "cigar_sizes": """SELECT cigar, sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) AS ref_len,
        sum(CASE WHEN op IN ('M', 'I', 'S', '=', 'X') THEN len ELSE 0 END) AS query_len FROM cigar_runs GROUP BY 1""",
    "mapped": "SELECT *, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM alignments WHERE flag & 4 = 0",
    "placed": "SELECT DISTINCT chrom, pos, cigar, strand FROM mapped",
    "placed_introns": """SELECT p.chrom, p.pos, p.cigar, pos + i1 AS i_start, pos + i2 AS i_end, overhang
        FROM (SELECT DISTINCT chrom, pos, cigar FROM mapped) p JOIN cigar_introns USING (cigar)""",
    "annotated": """SELECT DISTINCT chrom, prev_end + 1 AS i_start, start_pos - 1 AS i_end FROM (
        SELECT *, lag(end_pos) OVER (PARTITION BY gene_id, chrom ORDER BY start_pos, end_pos) AS prev_end
        FROM (SELECT DISTINCT gene_id, chrom, start_pos, end_pos FROM exons)) WHERE start_pos > prev_end + 1""",
    "sequences": """SELECT g.chrom, string_agg(coalesce(c.seq, repeat('N', 512)), '' ORDER BY g.chunk_no) AS bases
        FROM (SELECT chrom, unnest(range(0, max(chunk_no) + 1)) AS chunk_no FROM contigs GROUP BY 1) g
        LEFT JOIN contigs c ON c.chrom = g.chrom AND c.chunk_no = g.chunk_no GROUP BY 1""",
    "intron_motifs": """SELECT i.*, concat(substr(bases, i_start, 2), substr(bases, i_end - 1, 2)) AS motif
        FROM placed_introns i JOIN sequences USING (chrom)""",
    "intron_strands": """SELECT *, CASE WHEN motif IN ('GTAG', 'GCAG', 'ATAC') THEN '+'
        WHEN motif IN ('CTAC', 'CTGC', 'GTAT') THEN '-' END AS strand FROM intron_motifs""",
    "pairs": """SELECT DISTINCT p.chrom, p.pos, p.cigar, p.strand, e.gene_id, e.strand AS gene_strand
        FROM placed p JOIN cigar_blocks b ON b.cigar = p.cigar
        JOIN exons e ON e.chrom = p.chrom AND p.pos + b.o1 <= e.end_pos AND p.pos + b.o2 >= e.start_pos""",
    "placed_genes": """SELECT chrom, pos, cigar, strand, count(*) AS n_genes, min(gene_id) AS gene_id
        FROM pairs GROUP BY 1, 2, 3, 4""",
    "outcomes": """SELECT a.sample, a.read_id, CASE WHEN a.flag & 4 <> 0 THEN 'Unassigned_Unmapped'
        WHEN a.mapq < 10 THEN 'Unassigned_MappingQuality' WHEN a.nh > 1 THEN 'Unassigned_MultiMapping'
        WHEN g.n_genes = 1 THEN 'Assigned' WHEN g.n_genes > 1 THEN 'Unassigned_Ambiguity'
        ELSE 'Unassigned_NoFeatures' END AS status, g.gene_id
        FROM (SELECT *, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM alignments) a
        LEFT JOIN placed_genes g USING (chrom, pos, cigar, strand)""",
    "lengths": """SELECT gene_id, CAST(sum(e - s + 1) AS INTEGER) AS length FROM (
        SELECT gene_id, chrom, island, min(start_pos) AS s, max(end_pos) AS e FROM (
          SELECT *, sum(CASE WHEN start_pos <= top THEN 0 ELSE 1 END) OVER
              (PARTITION BY gene_id, chrom ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS island FROM (
            SELECT *, max(end_pos) OVER (PARTITION BY gene_id, chrom ORDER BY start_pos, end_pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM exons))
        GROUP BY 1, 2, 3) GROUP BY 1""",
    "samples": "SELECT DISTINCT sample FROM alignments",
    "assigned_matrix": """SELECT l.gene_id, s.sample, count(o.read_id) AS "count", l.length
        FROM lengths l CROSS JOIN samples s LEFT JOIN outcomes o
        ON o.gene_id = l.gene_id AND o.sample = s.sample AND o.status = 'Assigned' GROUP BY 1, 2, 4""",
    "per_read": """SELECT r.sample, r.read_id, max(nh) FILTER (flag & 4 = 0) AS nh FROM input_reads r
        LEFT JOIN alignments a ON a.sample = r.sample AND a.read_id = r.read_id GROUP BY 1, 2""",
    "rates": """SELECT sample, count(*) AS n_reads, count(*) FILTER (nh = 1) AS n_unique,
        count(*) FILTER (nh BETWEEN 2 AND 20) AS n_multi, count(*) FILTER (nh IS NULL OR nh > 20) AS n_unmapped
        FROM per_read GROUP BY 1""",
    "star_reads": """SELECT a.*, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM alignments a
        WHERE flag & 256 = 0 AND flag & 2048 = 0""",
    "star_hits": """SELECT chrom, pos, cigar, strand, count(*) AS n0, min(gene_id) AS g0,
        count(*) FILTER (strand = gene_strand) AS n1, min(gene_id) FILTER (strand = gene_strand) AS g1,
        count(*) FILTER (strand <> gene_strand) AS n2, min(gene_id) FILTER (strand <> gene_strand) AS g2
        FROM pairs GROUP BY 1, 2, 3, 4""",
    "star_targets": """SELECT sample, unnest(['unstranded', 'forward', 'reverse']) AS rule, 'N_unmapped' AS early, NULL AS late
        FROM input_reads r WHERE NOT EXISTS (SELECT 1 FROM star_reads s WHERE s.sample = r.sample AND s.read_id = r.read_id AND s.flag & 4 = 0)
        UNION ALL SELECT sample, unnest(['unstranded', 'forward', 'reverse']) AS rule,
        CASE WHEN nh > 1 THEN 'N_multimapping' END AS early,
        unnest([CASE WHEN n0 = 1 THEN g0 WHEN n0 > 1 THEN 'N_ambiguous' ELSE 'N_noFeature' END,
                CASE WHEN n1 = 1 THEN g1 WHEN n1 > 1 THEN 'N_ambiguous' ELSE 'N_noFeature' END,
                CASE WHEN n2 = 1 THEN g2 WHEN n2 > 1 THEN 'N_ambiguous' ELSE 'N_noFeature' END]) AS late
        FROM star_reads LEFT JOIN star_hits USING (chrom, pos, cigar, strand) WHERE flag & 4 = 0""",
    "chain_alignments": """SELECT sample, read_id, CASE WHEN i % 9 = 2 THEN 4 ELSE 0 END AS flag,
        CASE WHEN d % 5 = 4 THEN 'chrM' ELSE concat('chr', d % 5 + 1) END AS chrom, 1 + d * 7 % 4000 AS pos, n,
        CASE WHEN i % 9 <> 2 THEN (CASE WHEN i % 5 = 1 THEN 3 WHEN i % 7 = 1 THEN 30 ELSE 1 END) END AS nh
        FROM (SELECT sample, read_id, length(seq) AS n, CAST(regexp_extract(read_id, '^R([0-9]+)_', 1) AS BIGINT) AS d,
          CAST(regexp_extract(read_id, '_([0-9]+)$', 1) AS BIGINT) AS i FROM chain WHERE reason = 'passed')
        WHERE (d + i) % 4 <> 0""",
    "chain_outcomes": """SELECT a.sample, a.read_id, CASE WHEN flag & 4 <> 0 THEN 'Unassigned_Unmapped'
        WHEN nh > 1 THEN 'Unassigned_MultiMapping' WHEN count(DISTINCT e.gene_id) = 1 THEN 'Assigned'
        WHEN count(DISTINCT e.gene_id) > 1 THEN 'Unassigned_Ambiguity' ELSE 'Unassigned_NoFeatures' END AS status
        FROM chain_alignments a LEFT JOIN exons e ON e.chrom = a.chrom AND a.pos <= e.end_pos AND a.pos + n - 1 >= e.start_pos
        GROUP BY a.sample, a.read_id, flag, nh""",
    "chain_rates": """SELECT r.sample, count(*) AS n_reads, count(*) FILTER (nh = 1 AND flag = 0) AS n_unique,
        count(*) FILTER (nh BETWEEN 2 AND 20 AND flag = 0) AS n_multi,
        count(*) FILTER (flag IS NULL OR flag = 4 OR nh > 20) AS n_unmapped
        FROM (SELECT sample, read_id FROM chain WHERE reason = 'passed') r
        LEFT JOIN chain_alignments a ON a.sample = r.sample AND a.read_id = r.read_id GROUP BY 1""",
    "flag_lines": """SELECT sample, unnest(['total', 'primary', 'secondary', 'supplementary', 'duplicates', 'mapped',
          'primary mapped', 'paired in sequencing', 'properly paired', 'singletons']) AS metric,
        unnest([true, flag & 2304 = 0, flag & 256 <> 0, flag & 2048 <> 0 AND flag & 256 = 0, flag & 1024 <> 0,
          flag & 4 = 0, flag & 2308 = 0, flag & 2305 = 1, flag & 2311 = 3, flag & 2317 = 9]) AS hit,
        flag & 512 <> 0 AS failed FROM alignments""",
    "flag_counts": """SELECT sample, metric, count(*) FILTER (hit AND NOT failed) AS passed,
        count(*) FILTER (hit AND failed) AS failed, count(*) FILTER (NOT failed) AS rows_passed
        FROM flag_lines GROUP BY 1, 2""",
    "contig_counts": """SELECT s.sample, d.chrom, d.length, count(a.flag) FILTER (a.flag & 4 = 0) AS mapped,
        count(a.flag) FILTER (a.flag & 4 <> 0) AS unmapped
        FROM (SELECT chrom, length FROM dictionary UNION ALL SELECT '*', 0) d CROSS JOIN samples s
        LEFT JOIN alignments a ON a.sample = s.sample AND coalesce(a.chrom, '*') = d.chrom GROUP BY 1, 2, 3""",
    # --- expression ---------------------------------------------------------------
    "sizes": 'SELECT sample, CAST(sum("count") AS BIGINT) AS library_size FROM counts GROUP BY 1',
    "rpk": """SELECT gene_id, sample, length, "count",
        CAST("count" AS DOUBLE) / (CAST(length AS DOUBLE) / 1000.0::DOUBLE) AS rpk FROM counts""",
    "tpm": """SELECT gene_id, sample, length, "count", rpk, rpk / scale AS tpm FROM rpk
        JOIN (SELECT sample, sum(rpk) / 1000000 AS scale FROM rpk GROUP BY 1) USING (sample)""",
    "mean_tpm": """SELECT gene_id, length, sum(tpm) / (SELECT count(DISTINCT sample) FROM tpm) AS mean_tpm
        FROM tpm GROUP BY 1, 2""",
    "top_genes": """SELECT *, CAST(row_number() OVER (ORDER BY mean_tpm DESC, gene_id) AS INTEGER) AS rank
        FROM mean_tpm ORDER BY mean_tpm DESC, gene_id LIMIT 20""",
    "plotted": """SELECT gene_id, t.length, t.mean_tpm, t.rank, coalesce(max(tpm) FILTER (sample = 'A'), 0) AS A,
        coalesce(max(tpm) FILTER (sample = 'N'), 0) AS N, coalesce(max(tpm) FILTER (sample = 'R'), 0) AS R
        FROM top_genes t JOIN tpm USING (gene_id) GROUP BY 1, 2, 3, 4""",
}


def oracle(body: str) -> str:
    """``body`` with the views it needs in front."""
    needed: set[str] = set()

    def need(sql: str) -> None:
        words = set(re.findall(r"[a-z_]+", sql))
        for name in VIEWS:
            if name in words and name not in needed:
                needed.add(name)
                need(VIEWS[name])

    need(body)
    blocks = ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items() if name in needed)
    return f"WITH {blocks}\n{body}" if blocks else body
