from seqlab.sources.files import corrupt_files, file_digest  # noqa: F401
from seqlab.sources.sequences import FastaSource, FastqSource, complete_pairs, register  # noqa: F401
from seqlab.sources.sinks import write_contig_files, write_fasta, write_fastq, write_read_files, write_sheet  # noqa: F401
from seqlab.sources.splits import read_fasta, read_fastq  # noqa: F401
from seqlab.sources.tables import malformed_reports, read_first_row, read_hits, read_reports, read_sheet  # noqa: F401
